"""The end-to-end jobs, as functions of paths and options.

Each composes the operators of this package the way one of the original
programs did, so a user of those programs can run the same job here:

* `sentiment_job`      - labelled CSV lines -> TF-IDF -> linear SVM (AUC) and
                         Naive Bayes (accuracy); separate train/test files, or
                         one file split 60/40.
* `tfidf_example`      - sentences -> hashed TF-IDF vectors.
* `score_stream`       - new sentences (a stream) -> SVM margin and label.
* `word_count_stream`  - text lines -> running word count, sorted by count.
* `sensor_stream`      - `uuid,heart_rate,calorie` lines -> running totals and
                         averages with the reset rule (`track_count=False` for
                         the totals-only variant).
* `tweets_to_table`    - Kafka records -> JSON -> newest value per key in a
                         keyed table, with the per-batch offset audit.

Streams return the started `StreamingQuery`; the checkpoint folder is per
query (restart resumes state and offsets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.functions.scalars import is_uuid, parse_sensor_line
from spindle.session import ensure_checkpoint_dir
from spindle.operators import features as feat
from spindle.operators import models
from spindle.operators.setops import sample_fraction, subtract_keep_duplicates
from spindle.sinks.keyed_table import KeyedTable
from spindle.sources.text import (parse_csv_layout_a, parse_csv_layout_b, parse_csv_quoted, read_lines)
from spindle.streaming.control import start
from spindle.streaming.keyed import tweets_from_records, upsert_batch_fn
from spindle.streaming.sensor import sensor_state_stream
from spindle.streaming.wordcount import running_word_counts

_LAYOUTS = {
    "a": parse_csv_layout_a,
    "b": parse_csv_layout_b,
    "a_quoted": parse_csv_quoted,
}


def labelled_lines(spark: SparkSession, path: str, layout: str = "a", rejects_path: str | None = None) -> DataFrame:
    """CSV lines of one of the layouts -> `(label, sentence)`. Headers and lines
    with a bad label go to `rejects_path` as text (by default a folder `rejects`
    under the shared checkpoint folder)."""
    good, bad = _LAYOUTS[layout](read_lines(spark, path), with_rejects=True)
    bad.select("line").write.mode("append").text(rejects_path or _rejects(spark, "labelled_lines"))
    return good


def _rejects(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/rejects/{spark.sparkContext.applicationId}/{name}"


def sentiment_job(spark: SparkSession, train_path: str, test_path: str | None = None,
                  train_layout: str = "b", test_layout: str = "a", buckets: int = models.SVM_BUCKETS,
                  iterations: int = models.SVM_ITERATIONS, fraction: float = 0.6, seed: int = 11,
                  rejects_path: str | None = None) -> dict:
    """Train on `train_path` and score `test_path`; without a test file the
    training lines are sampled (`fraction`, `seed`) and the rest is the test
    set (subtract). Returns the two fitted models and one-row DataFrames
    `auc` and `accuracy`."""
    data = labelled_lines(spark, train_path, train_layout, rejects_path)
    if test_path:
        train, test = data, labelled_lines(spark, test_path, test_layout, rejects_path)
    else:
        train = sample_fraction(data, fraction, seed)
        test = subtract_keep_duplicates(data, train)
    svm = models.fit(models.svm_pipeline(buckets, iterations), train)
    nb = models.fit(models.nb_pipeline(buckets), train)
    return {
        "svm": svm,
        "nb": nb,
        "auc": models.area_under_roc(models.svm_scores(svm, test)),
        "accuracy": models.accuracy(models.predictions(nb, test)),
    }


def tfidf_example(sentences: DataFrame, buckets: int = 20) -> DataFrame:
    """`(label, sentence)` -> `(label, features)` with hashed TF-IDF."""
    return feat.hashed_tfidf(sentences, buckets).transform(sentences).select("label", "features")


def word_count_stream(lines: DataFrame, name: str = "word_count", sort: bool = True,
                      trigger: dict | None = None, sink: str = "console",
                      checkpoint_location: str | None = None, foreach_batch=None, mode: str = "complete"):
    """Running count of every word. `complete` re-emits all words each batch
    (sorted by count, like the original per-batch dump); `update` emits only
    the words a batch touched - same totals, output proportional to the batch,
    the choice for an unbounded vocabulary."""
    counts = running_word_counts(lines, sort=sort and mode == "complete")
    return start(counts, name, mode, sink=sink, trigger=trigger or {"processingTime": "10 seconds"},
                 checkpoint_location=checkpoint_location, foreach_batch=foreach_batch)


def score_stream(lines: DataFrame, model, name: str = "scores", line: str = "value",
                 trigger: dict | None = None, sink: str = "console", checkpoint_location: str | None = None,
                 foreach_batch=None):
    """Score each new sentence of a stream with a fitted TF-IDF + SVM
    `PipelineModel`: raw margin and predicted label per line (stateless)."""
    from pyspark.ml.functions import vector_to_array
    sentences = lines.select(F.col(line).alias("sentence"))
    scored = model.transform(sentences).select(
        "sentence", vector_to_array("rawPrediction")[1].alias("score"), "prediction")
    return start(scored, name, "append", sink=sink, trigger=trigger or {"processingTime": "1 second"},
                 checkpoint_location=checkpoint_location, foreach_batch=foreach_batch)


def parse_sensor_lines(lines: DataFrame, line: str = "value", with_rejects: bool = False):
    """`uuid,heart_rate,calorie` lines -> readings; lines with a bad UUID or
    number are rejected (kept apart, not dropped silently)."""
    rec = lines.select(parse_sensor_line(F.col(line)).alias("r"), F.col(line).alias("line"))
    ok = F.coalesce(is_uuid(F.col("r.session_id")) & F.col("r.heart_rate").isNotNull() & F.col("r.calorie").isNotNull(), F.lit(False))
    good = rec.filter(ok).select("r.*")
    if not with_rejects:
        return good
    return good, rec.filter(~ok).select("line")


def sensor_stream(lines: DataFrame, name: str = "sensor", track_count: bool = True, on_reset: str = "keep",
                  trigger: dict | None = None, sink: str = "console", checkpoint_location: str | None = None,
                  foreach_batch=None, rejects_path: str | None = None):
    """Running totals per session. Bad lines are appended to `rejects_path` as text
    by a second query, `<name>_rejects` (by default a folder `rejects` under the
    shared checkpoint folder)."""
    readings, bad = parse_sensor_lines(lines, with_rejects=True)
    start(bad, f"{name}_rejects", "append", sink="text", trigger=trigger or {"processingTime": "5 seconds"},
          checkpoint_location=checkpoint_location and f"{checkpoint_location.rstrip('/')}_rejects",
          options={"path": rejects_path or _rejects(lines.sparkSession, name)})
    states = sensor_state_stream(readings, track_count=track_count, on_reset=on_reset)
    return start(states, name, "update", sink=sink, trigger=trigger or {"processingTime": "5 seconds"},
                 checkpoint_location=checkpoint_location, foreach_batch=foreach_batch)


def tweets_to_table(records: DataFrame, table_path: str, audit_path: str | None = None,
                    name: str = "tweets_to_table", trigger: dict | None = None,
                    checkpoint_location: str | None = None, key: str = "id_str"):
    """Kafka records (stream) -> newest value per key in a keyed table.
    `key`: "id_str" (the tweet id, as the original job keyed its rows) or "key"
    (the record key, which producers often leave null)."""
    values = [c for c in ["key", "id_str", "created_at", "text"] if c != key]
    table = KeyedTable(table_path, key, ["timestamp", "offset"], values)
    tweets = tweets_from_records(records)
    return start(tweets, name, "append", trigger=trigger or {"processingTime": "10 seconds"},
                 checkpoint_location=checkpoint_location, foreach_batch=upsert_batch_fn(table, audit_path))

"""Registered queries: name -> f(spark, data_dir) -> DataFrame.

Each reads whole tables (or data Spark derives from them). Computed doubles
are rounded to 6 places in the final projection only, so results compare
across engines; all arithmetic before that runs at full precision.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.functions.scalars import binarize_label, bucket_start, int_div, is_uuid, parse_sensor_line
from spindle.operators import features as feat
from spindle.operators import models
from spindle.operators.lookup import roles_of_user
from spindle.operators.naive_bayes import nb_exact
from spindle.operators.offsets import offset_ranges
from spindle.operators.prefix import auc_rank_sum
from spindle.operators.ranking import ranked
from spindle.operators.running import every_state, running_totals, state_as_of
from spindle.operators.sessions import marker_sessions
from spindle.operators.setops import hash_bucket, hash_split, subtract_keep_duplicates, union_all
from spindle.operators.sliding import sliding_counts
from spindle.operators.subgradient import svm_weights
from spindle.operators.upsert import latest_per_key, to_cells
from spindle.operators.wordcount import line_words, text_to_lines, top_words, word_counts
from spindle.plans import derived
from spindle.sources.json import TWEET_SCHEMA, project_json
from spindle.sources.kafka import kafka_value
from spindle.sources.tables import read_table, smaller_parts
from spindle.session import ensure_checkpoint_dir
from spindle.sinks.models import model_path, save_model
from spindle.sources.text import (one_class_text, parse_csv_layout_a, parse_csv_layout_b, parse_csv_quoted,
                                  parse_tsv_label_first, parse_tsv_text_first, read_libsvm, read_lines, write_libsvm)

# Query parameters.
TOP_K = 10
TRAIN_FRACTION = 0.6
SPLIT_SEED = 11
SAMPLE_SEED = 29
STEPS = 5  # of the SVM by aggregates
SLIDE_SECONDS = 60
WINDOW_SECONDS = 300
LOOKUP_USER = "Customer#000000001"
CELL_FAMILY = "twt"
CELL_QUALIFIERS = {"createdat": "created_at"}


def _tag(d: str) -> str:
    return hashlib.md5(d.encode()).hexdigest()[:12]


def _shared_path(spark: SparkSession, kind: str, d: str) -> str:
    """A folder of this application and data folder under the shared one, so that
    two applications never write to the same files."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{kind}/{spark.sparkContext.applicationId}/{_tag(d)}"


def _r(c, digits: int = 6):
    return F.round(c, digits)


# ---------------------------------------------------------------- word counts
def word_count(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text"], spread_key="doc_id").select("text")
    return word_counts(line_words(text_to_lines(docs)))


def word_count_top(spark: SparkSession, d: str) -> DataFrame:
    return top_words(word_count(spark, d), TOP_K)


def word_count_sorted(spark: SparkSession, d: str) -> DataFrame:
    """Every word as (n, word, rank), sorted by count descending (range-partitioned
    global sort), the per-batch output of the running word count."""
    counts = ranked(word_count(spark, d), [F.col("n").desc(), F.col("word").asc()], _shared_path(spark, "ranked-words", d))
    return counts.select("n", "word", "rank").orderBy("rank")


def text_file_words(spark: SparkSession, d: str) -> DataFrame:
    """Word counts of text files: the documents written as lines under the shared
    folder and read by a text scan."""
    path = _shared_path(spark, "text", d)
    docs = read_table(spark, d, "documents", ["doc_id", "text"], spread_key="doc_id").where("text != ''")
    docs.select("text").write.mode("overwrite").text(path)
    return word_counts(line_words(read_lines(spark, path).withColumnRenamed("value", "line")))


# -------------------------------------------------------------- running state
def word_count_running_turns(spark: SparkSession, d: str) -> DataFrame:
    """Running word count over the lines of the conversations, batch by turn."""
    per = word_counts(derived.turn_words(spark, d), by=["batch"])
    out = running_totals(per, key="word", order="batch", values=["n"], prefix="total_",
                         chunk=F.floor(F.col("batch") / derived.TURN_CHUNK))
    return out.select("word", "batch", F.col("n").alias("batch_n"), F.col("total_n").alias("n"))


def word_count_every_turn(spark: SparkSession, d: str) -> DataFrame:
    """Every word seen so far and its count at every turn (what the state stream
    prints each batch, untouched words included)."""
    turns = read_table(spark, d, "conversations").select(F.col("turn").alias("batch"))
    states = word_count_running_turns(spark, d)
    return every_state(states, "word", "batch", "n", turns, derived.TURN_CHUNK)


def sensor_lines(spark: SparkSession, d: str) -> DataFrame:
    """Sensor lines parsed from text: readings of good lines, and the bad ones kept
    with their line."""
    lines = derived.sensor_lines(spark, d)
    r = parse_sensor_line(F.col("value"))
    ok = F.coalesce(is_uuid(F.col("r.session_id")) & F.col("r.heart_rate").isNotNull() & F.col("r.calorie").isNotNull(), F.lit(False))
    rec = lines.select("event_id", "value", r.alias("r")).withColumn("ok", ok)
    only = lambda c: F.when(F.col("ok"), F.col(c))
    return rec.select("event_id", "ok", only("r.session_id").alias("session_id"), only("r.heart_rate").alias("heart_rate"),
                      only("r.calorie").alias("calorie"), F.when(~F.col("ok"), F.col("value")).alias("rejected"))


def word_count_running(spark: SparkSession, d: str) -> DataFrame:
    per = word_counts(derived.event_words(spark, d), by=["batch"])  # (batch, word, n)
    out = running_totals(per, key="word", order="batch", values=["n"], prefix="total_",
                         chunk=bucket_start("batch", derived.WORD_CHUNK))
    return out.select("word", "batch", F.col("n").alias("batch_n"), F.col("total_n").alias("n"))


def _sensor_batches(spark: SparkSession, d: str) -> DataFrame:
    r = derived.sensor_readings(spark, d)
    return r.groupBy("session_id", "batch").agg(
        F.sum("heart_rate").alias("hr"), F.sum("calorie").alias("cal"), F.count(F.lit(1)).alias("n"))


def sensor_running_avg(spark: SparkSession, d: str) -> DataFrame:
    per = _sensor_batches(spark, d)
    reset = (F.col("hr") == -1) & (F.col("cal") == -1)
    st = running_totals(per, "session_id", "batch", ["hr", "cal", "n"], reset=reset,
                        reset_values={"n": 1}, chunk=bucket_start("batch", derived.SENSOR_CHUNK),
                        prefix="total_")
    return st.select("session_id", "batch", "total_hr", "total_cal", "total_n",
                     int_div("total_hr", "total_n").alias("avg_hr"),
                     int_div("total_cal", "total_n").alias("avg_cal"))


def sensor_state_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """What the state stream prints at its last batch: every session's state
    as of that batch (untouched sessions keep their last state)."""
    return state_as_of(sensor_running_avg(spark, d), "session_id", "batch")


def track_running_totals(spark: SparkSession, d: str) -> DataFrame:
    per = _sensor_batches(spark, d)
    reset = (F.col("hr") == -1) & (F.col("cal") == -1)
    st = running_totals(per, "session_id", "batch", ["hr", "cal"], reset=reset,
                        chunk=bucket_start("batch", derived.SENSOR_CHUNK), prefix="total_")
    return st.select("session_id", "batch", "total_hr", "total_cal")


def session_marker_totals(spark: SparkSession, d: str) -> DataFrame:
    """Row-level end-of-session rule: a marker closes the session it ends
    (state cleared); sessions are numbered per key by markers seen before."""
    return marker_sessions(derived.sensor_readings(spark, d), "session_id", ["ts", "event_id"],
                           chunk=bucket_start("ts", derived.ROW_CHUNK))


def sliding_count(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("ts", "event_type")
    return sliding_counts(ev, "ts", "event_type", WINDOW_SECONDS, SLIDE_SECONDS)


def sliding_count_1s(spark: SparkSession, d: str) -> DataFrame:
    """The five-minute window at the original slide of one second."""
    ev = read_table(spark, d, "events").select("ts", "event_type")
    return sliding_counts(ev, "ts", "event_type", WINDOW_SECONDS, 1)


# ------------------------------------------------------------ kafka and json
def _tweets(spark: SparkSession, d: str) -> DataFrame:
    schema = T.StructType(TWEET_SCHEMA.fields + [T.StructField("k", T.IntegerType())])
    recs = kafka_value(derived.kafka_records(spark, d))
    return project_json(recs, "value", schema, keep=["key", "offset", "timestamp"])


def json_project(spark: SparkSession, d: str) -> DataFrame:
    return _tweets(spark, d).select("id_str", "created_at", "text", "k")


def keyed_upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    latest = latest_per_key(_tweets(spark, d), "key", ["timestamp", "offset"], ["created_at"])
    return to_cells(latest, "key", CELL_FAMILY, CELL_QUALIFIERS)


def tweet_upsert_by_id(spark: SparkSession, d: str) -> DataFrame:
    """The same put keyed by the tweet id, as the original job keys its rows."""
    latest = latest_per_key(_tweets(spark, d), "id_str", ["timestamp", "offset"], ["created_at"])
    return to_cells(latest, "id_str", CELL_FAMILY, CELL_QUALIFIERS)


def kafka_offset_ranges(spark: SparkSession, d: str) -> DataFrame:
    recs = derived.kafka_records(spark, d).withColumn("batch", bucket_start("timestamp", derived.HOUR))
    return offset_ranges(recs, by=["batch"])


# ------------------------------------------------------------- line formats
def csv_label_naive(spark: SparkSession, d: str) -> DataFrame:
    return parse_csv_layout_a(derived.csv_lines_layout_a(spark, d), keep=["doc_id"])


def csv_label_quoted(spark: SparkSession, d: str) -> DataFrame:
    return parse_csv_quoted(derived.csv_lines_layout_a(spark, d), keep=["doc_id"])


def csv_layout_b(spark: SparkSession, d: str) -> DataFrame:
    return parse_csv_layout_b(derived.csv_lines_layout_b(spark, d), keep=["doc_id"])


def tsv_default_label(spark: SparkSession, d: str) -> DataFrame:
    return parse_tsv_text_first(derived.tsv_lines_text_first(spark, d), keep=["doc_id"])


def tsv_label_first(spark: SparkSession, d: str) -> DataFrame:
    return parse_tsv_label_first(derived.tsv_lines_label_first(spark, d), keep=["doc_id"])


def union_all_one_class(spark: SparkSession, d: str) -> DataFrame:
    """Two one-class line sources (lines of positive and of negative
    documents), each with its constant label, unioned with duplicates."""
    lab = derived.labelled_docs(spark, d)
    pos = text_to_lines(lab.filter(F.col("label") == 1.0).select("doc_id", F.col("sentence").alias("text")),
                        keep=["doc_id"]).withColumnRenamed("line", "value")
    neg = text_to_lines(lab.filter(F.col("label") == 0.0).select("doc_id", F.col("sentence").alias("text")),
                        keep=["doc_id"]).withColumnRenamed("line", "value")
    return union_all(one_class_text(pos, 1.0, keep=["doc_id"]), one_class_text(neg, 0.0, keep=["doc_id"]))


# ----------------------------------------------------------------- features
def tokens(spark: SparkSession, d: str) -> DataFrame:
    return feat.doc_tokens(read_table(spark, d, "documents", ["doc_id", "text"], spread_key="doc_id"))


def tf(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text"], spread_key="doc_id")
    return feat.term_frequencies(feat.doc_tokens(smaller_parts(docs, "doc_id")))


def _idf(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id")
    return feat.inverse_document_frequencies(tf(spark, d), feat.n_docs_of(docs))


def idf(spark: SparkSession, d: str) -> DataFrame:
    return _idf(spark, d).select("term", "df", _r(F.col("idf")).alias("idf"))


def tfidf(spark: SparkSession, d: str) -> DataFrame:
    out = feat.tfidf(tf(spark, d), _idf(spark, d))
    return out.select("doc_id", "term", "tf", _r(F.col("idf")).alias("idf"), _r(F.col("tfidf")).alias("tfidf"))


# ---------------------------------------------------------- splits and models
def _split(spark: SparkSession, d: str):
    return hash_split(derived.labelled_docs(spark, d), "doc_id", TRAIN_FRACTION, SPLIT_SEED)


def train_test_subtract(spark: SparkSession, d: str) -> DataFrame:
    """Test rows as `all minus train` with an explicit subtract (left-anti
    join on every column, duplicates kept)."""
    train, _ = _split(spark, d)
    return subtract_keep_duplicates(derived.labelled_docs(spark, d), train)


def sample_60(spark: SparkSession, d: str) -> DataFrame:
    """A 60 % sample by a hash of the id: the same rows on any cluster and plan."""
    picked = hash_bucket("doc_id", SAMPLE_SEED) < int(TRAIN_FRACTION * 100)
    return derived.labelled_docs(spark, d).where(picked).select("doc_id", "label")


_MODELS: dict = {}
_SHARED: dict = {}


def _hashed_docs(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, rawFeatures) of every document, written once per application and
    data folder: texts are tokenized once and never shuffled; all model queries
    join, split and score these narrow rows."""
    path = _shared_path(spark, "hashed", d)
    if path not in _SHARED:
        docs = read_table(spark, d, "documents", ["doc_id", "text"], spread_key="doc_id")
        hashed = feat.hashed_tf(docs.withColumnRenamed("text", "sentence"), models.SVM_BUCKETS).select("doc_id", "rawFeatures")
        hashed.write.mode("overwrite").parquet(path)
        _SHARED[path] = hashed.schema
    return spark.read.schema(_SHARED[path]).parquet(path)


def _hashed_split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the labelled documents as (doc_id, label, rawFeatures)."""
    labels = read_table(spark, d, "labels").select("doc_id", binarize_label("quality").alias("label"))
    return hash_split(_hashed_docs(spark, d).join(labels, "doc_id"), "doc_id", TRAIN_FRACTION, SPLIT_SEED)


def _model(spark: SparkSession, d: str, kind: str):
    """Fit once per (application, data dir, kind); queries share the model."""
    key = (spark.sparkContext.applicationId, d, kind)
    if key not in _MODELS:
        train, _ = _hashed_split(spark, d)
        pipe = models.svm_pipeline() if kind == "svm" else models.nb_pipeline()
        _MODELS[key] = models.fit_hashed(pipe, train)
    return _MODELS[key]


def _saved_svm(spark: SparkSession, d: str) -> PipelineModel:
    """The SVM after a save and a load."""
    ensure_checkpoint_dir(spark)
    path = model_path(spark, f"svm-{spark.sparkContext.applicationId}-{_tag(d)}")
    save_model(_model(spark, d, "svm"), path)
    return PipelineModel.load(path)


def hashing_tfidf(spark: SparkSession, d: str) -> DataFrame:
    train, _ = _split(spark, d)
    pm = feat.hashed_tfidf(train, models.SVM_BUCKETS)
    out = pm.transform(derived.labelled_docs(spark, d))
    return out.select("doc_id", "label", vector_to_array("features").alias("features"))


def _tfidf_rows(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents with rawFeatures and features, the IDF fitted on the
    training part."""
    train, _ = _hashed_split(spark, d)
    labels = read_table(spark, d, "labels").select("doc_id", binarize_label("quality").alias("label"))
    return feat.fitted_idf(train).transform(_hashed_docs(spark, d).join(labels, "doc_id"))


def hashing_tfidf_cells(spark: SparkSession, d: str) -> DataFrame:
    """The hashed TF-IDF features as rows (doc_id, label, bucket, tf, tfidf), one for
    each bucket that a document fills."""
    cells = F.arrays_zip(vector_to_array("rawFeatures").alias("tf"), vector_to_array("features").alias("tfidf"))
    out = _tfidf_rows(spark, d).select("doc_id", "label", F.posexplode(cells).alias("bucket", "c"))
    return out.where("c.tf > 0").select("doc_id", "label", "bucket", F.col("c.tf").cast("bigint").alias("tf"), _r(F.col("c.tfidf")).alias("tfidf"))


def libsvm_cells(spark: SparkSession, d: str) -> DataFrame:
    """The same features after a LIBSVM round trip (the id travels as the label)."""
    path = f"{_shared_path(spark, 'libsvm-cells', d)}/{uuid.uuid4().hex[:12]}"
    write_libsvm(_tfidf_rows(spark, d).select(F.col("doc_id").cast("double").alias("label"), "features"), path)
    out = read_libsvm(spark, path).select(F.col("label").cast("bigint").alias("doc_id"), F.posexplode(vector_to_array("features")).alias("bucket", "x"))
    return out.where("x != 0").select("doc_id", "bucket", _r(F.col("x")).alias("tfidf"))


def svm_step_weights(spark: SparkSession, d: str) -> DataFrame:
    """The SVM's weights after STEPS subgradient steps, each an aggregate over the
    training rows."""
    train, _ = _hashed_split(spark, d)
    rows = feat.fitted_idf(train).transform(train).select("label", vector_to_array("features").alias("features"))
    path = f"{_shared_path(spark, 'svm-steps', d)}/{uuid.uuid4().hex[:12]}"
    out = svm_weights(rows, models.SVM_BUCKETS, STEPS, path, reg_param=models.SVM_REG)
    return out.select("bucket", _r(F.col("weight")).alias("weight"))


def svm_scores(spark: SparkSession, d: str) -> DataFrame:
    _, test = _hashed_split(spark, d)
    return models.svm_scores(models.after_hashing(_model(spark, d, "svm")), test, keep=["doc_id"])


def svm_auc(spark: SparkSession, d: str) -> DataFrame:
    return models.area_under_roc(svm_scores(spark, d))


def auc_by_rank(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id", "n_chars")
    labels = read_table(spark, d, "labels").select("doc_id", "quality")
    scored = docs.join(labels, "doc_id").select(F.col("n_chars").alias("score"), F.col("quality").alias("label"))
    out = auc_rank_sum(scored)
    return out.select(_r(F.col("auc")).alias("auc"), "n_pos", "n_neg")


def nb_predict_exact(spark: SparkSession, d: str) -> DataFrame:
    train, test = _split(spark, d)
    return nb_exact(train, test)


def linear_score_auc(spark: SparkSession, d: str) -> DataFrame:
    """AUC of a fixed linear score, through the report that the SVM uses."""
    docs = read_table(spark, d, "documents").select("doc_id", "n_chars")
    labels = read_table(spark, d, "labels").select("doc_id", "quality")
    score = F.col("n_chars") * 0.25 - F.pmod(F.col("doc_id"), F.lit(7)) * 64.0
    scored = docs.join(labels, "doc_id").select(score.alias("score"), binarize_label("quality").alias("label"))
    return models.area_under_roc(scored).select(_r(F.col("auc")).alias("auc"), "n_pos", "n_neg")


def nb_exact_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy report of the exact-term Naive Bayes."""
    return models.accuracy(nb_predict_exact(spark, d)).select(_r(F.col("accuracy")).alias("accuracy"), "n_correct", "n_test")


def _raw_mass(df: DataFrame) -> DataFrame:
    mass = F.aggregate(vector_to_array("rawFeatures"), F.lit(0.0), lambda a, x: a + x)
    return df.select("doc_id", mass.cast("bigint").alias("n_tokens"))


def hashing_tf_mass(spark: SparkSession, d: str) -> DataFrame:
    """Hashed term frequencies summed over all buckets: a document's tokens."""
    hashed = feat.hashed_tf(derived.labelled_docs(spark, d), models.SVM_BUCKETS)
    return _raw_mass(hashed)


def libsvm_tf_mass(spark: SparkSession, d: str) -> DataFrame:
    """The same sums after a LIBSVM round trip, the id travelling as the label."""
    path = _shared_path(spark, "libsvm-mass", d)
    hashed = feat.hashed_tf(derived.labelled_docs(spark, d), models.SVM_BUCKETS)
    write_libsvm(hashed.select(F.col("doc_id").cast("double").alias("label"), F.col("rawFeatures").alias("features")), path)
    back = read_libsvm(spark, path).select(F.col("label").cast("bigint").alias("doc_id"), F.col("features").alias("rawFeatures"))
    return _raw_mass(back)


def svm_label_counts(spark: SparkSession, d: str) -> DataFrame:
    """Scored rows by label, of the test split and of documents without a label. A row
    counts only if its margin is on the side of its prediction and the saved and
    loaded model gives the same margin as the fitted one."""
    fitted, loaded = (models.after_hashing(m) for m in (_model(spark, d, "svm"), _saved_svm(spark, d)))
    margin = vector_to_array("rawPrediction")[1]
    sided = (margin > 0) == (F.col("prediction") == 1.0)

    def agreeing(rows: DataFrame) -> DataFrame:
        once = fitted.transform(rows).select("doc_id", "label", "rawFeatures", margin.alias("score"), sided.alias("sided"))
        again = loaded.transform(once).select("label", (F.col("sided") & sided & (F.col("score") == margin)).alias("same"))
        return again.where("same").select("label")

    _, test = _hashed_split(spark, d)
    labelled = agreeing(test).select(F.col("label").cast("string").alias("label"))
    new = agreeing(_unlabelled(spark, d)).select(F.lit("none").alias("label"))
    return labelled.unionAll(new).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def nb_accuracy(spark: SparkSession, d: str) -> DataFrame:
    _, test = _hashed_split(spark, d)
    return models.accuracy(models.predictions(models.after_hashing(_model(spark, d, "nb")), test))


def _unlabelled(spark: SparkSession, d: str) -> DataFrame:
    labels = read_table(spark, d, "labels").select("doc_id")
    return _hashed_docs(spark, d).join(labels, "doc_id", "left_anti").select("doc_id", F.lit(None).cast("double").alias("label"), "rawFeatures")


def score_new(spark: SparkSession, d: str) -> DataFrame:
    """Documents without a label, scored by the saved-then-loaded SVM model."""
    out = models.after_hashing(_saved_svm(spark, d)).transform(_unlabelled(spark, d))
    return out.select("doc_id", vector_to_array("rawPrediction")[1].alias("score"), "prediction")


def libsvm_features(spark: SparkSession, d: str) -> DataFrame:
    """Hashed TF-IDF features written as LIBSVM text under the shared folder
    and loaded back with the feature count inferred from the file."""
    ensure_checkpoint_dir(spark)
    train, _ = _split(spark, d)
    pm = feat.hashed_tfidf(train, models.SVM_BUCKETS)
    path = _shared_path(spark, "libsvm", d)
    write_libsvm(pm.transform(train), path)
    return read_libsvm(spark, path).select("label", vector_to_array("features").alias("features"))


# ------------------------------------------------------------------- lookup
def key_role_lookup(spark: SparkSession, d: str) -> DataFrame:
    return roles_of_user(derived.users(spark, d), derived.user_roles(spark, d), LOOKUP_USER)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count": word_count,
    "word_count_top": word_count_top,
    "word_count_sorted": word_count_sorted,
    "word_count_running": word_count_running,
    "sensor_running_avg": sensor_running_avg,
    "sensor_state_snapshot": sensor_state_snapshot,
    "track_running_totals": track_running_totals,
    "session_marker_totals": session_marker_totals,
    "sliding_count": sliding_count,
    "sliding_count_1s": sliding_count_1s,
    "json_project": json_project,
    "keyed_upsert_latest": keyed_upsert_latest,
    "kafka_offset_ranges": kafka_offset_ranges,
    "csv_label_naive": csv_label_naive,
    "csv_label_quoted": csv_label_quoted,
    "csv_layout_b": csv_layout_b,
    "tsv_default_label": tsv_default_label,
    "tsv_label_first": tsv_label_first,
    "union_all": union_all_one_class,
    "tokens": tokens,
    "tf": tf,
    "idf": idf,
    "tfidf": tfidf,
    "train_test_subtract": train_test_subtract,
    "sample_60": sample_60,
    "hashing_tfidf": hashing_tfidf,
    "svm_scores": svm_scores,
    "svm_auc": svm_auc,
    "auc_by_rank": auc_by_rank,
    "nb_predict_exact": nb_predict_exact,
    "nb_accuracy": nb_accuracy,
    "score_new": score_new,
    "libsvm_features": libsvm_features,
    "key_role_lookup": key_role_lookup,
    "text_file_words": text_file_words,
    "word_count_running_turns": word_count_running_turns,
    "sensor_lines": sensor_lines,
    "tweet_upsert_by_id": tweet_upsert_by_id,
    "linear_score_auc": linear_score_auc,
    "nb_exact_accuracy": nb_exact_accuracy,
    "hashing_tf_mass": hashing_tf_mass,
    "libsvm_tf_mass": libsvm_tf_mass,
    "svm_label_counts": svm_label_counts,
    "word_count_every_turn": word_count_every_turn,
    "hashing_tfidf_cells": hashing_tfidf_cells,
    "libsvm_cells": libsvm_cells,
    "svm_step_weights": svm_step_weights,
}


def run_query(spark: SparkSession, name: str, data_dir: str) -> DataFrame:
    return QUERIES[name](spark, data_dir)

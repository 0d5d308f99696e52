"""End-to-end jobs on files rendered from the given tables."""

import os

from pyspark.sql import functions as F

from spindle import jobs
from spindle.plans import derived
from spindle.sinks.keyed_table import KeyedTable
from tests.conftest import SF001


def _write_lines(df, path):
    df.select("value").coalesce(1).write.mode("overwrite").text(path)
    return path


def test_sentiment_job_with_train_and_test_files(spark, scratch):
    train = _write_lines(derived.csv_lines_layout_b(spark, SF001), os.path.join(scratch, "train"))
    test = _write_lines(derived.csv_lines_layout_a(spark, SF001), os.path.join(scratch, "test"))
    out = jobs.sentiment_job(spark, train, test, train_layout="b", test_layout="a", iterations=20)
    auc = out["auc"].first()
    acc = out["accuracy"].first()
    assert 0.0 <= auc.auc <= 1.0 and auc.n_pos + auc.n_neg == 87
    assert 0.0 <= acc.accuracy <= 1.0 and acc.n_test == 87


def test_sentiment_job_single_file_split(spark, scratch):
    lines = _write_lines(derived.csv_lines_layout_a(spark, SF001), os.path.join(scratch, "all"))
    out = jobs.sentiment_job(spark, lines, None, train_layout="a_quoted", iterations=10)
    n_test = out["accuracy"].first().n_test
    assert 0 < n_test < 87


def test_tfidf_example(spark):
    from spindle.sources.text import sentences
    rows = [(0.0, "Hi I heard about Spark"), (0.0, "I wish Java could use case classes"),
            (1.0, "Logistic regression models are neat")]
    out = jobs.tfidf_example(sentences(spark, rows), 20).collect()
    assert len(out) == 3 and all(r.features.size == 20 for r in out)


def test_sensor_stream_job_from_lines(spark, scratch):
    src = os.path.join(scratch, "lines")
    os.makedirs(src)
    u = "11111111-1111-1111-1111-111111111111"
    batches = [[f"{u},70,2", f"{u},80,4", "garbage,1,2"], [f"{u},60,3"], [f"{u},-1,-1"], [f"{u},90,6"]]
    out = os.path.join(scratch, "out")

    def write(b, i):
        b.withColumn("batch_id", F.lit(i)).write.mode("append").parquet(out)

    for i, b in enumerate(batches):
        with open(os.path.join(src, f"b{i:03d}.txt"), "w") as f:
            f.write("\n".join(b) + "\n")
        os.utime(os.path.join(src, f"b{i:03d}.txt"), (1_000_000 + i, 1_000_000 + i))
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    q = jobs.sensor_stream(lines, "sensor_job", trigger={"availableNow": True},
                           checkpoint_location=os.path.join(scratch, "ck"), foreach_batch=write)
    q.awaitTermination(300)
    got = [(r.total_hr, r.total_cal, r.total_n, r.avg_hr, r.avg_cal)
           for r in spark.read.parquet(out).orderBy("batch_id").collect()]
    assert got == [(150, 6, 2, 75, 3), (210, 9, 3, 70, 3), (0, 0, 1, 0, 0), (90, 6, 2, 45, 3)]


def test_tweets_to_table_job(spark, scratch):
    recs = derived.kafka_records(spark, SF001)
    src = os.path.join(scratch, "recs")
    recs.write.parquet(src)
    stream = spark.readStream.schema(recs.schema).parquet(src)
    table_path = os.path.join(scratch, "table")
    q = jobs.tweets_to_table(stream, table_path, os.path.join(scratch, "audit"), trigger={"availableNow": True},
                             checkpoint_location=os.path.join(scratch, "ck"))
    q.awaitTermination(300)
    table = KeyedTable(table_path, "key", ["timestamp", "offset"], ["id_str", "created_at", "text"])
    got = table.read(spark)
    assert got.count() == recs.select("key").distinct().count()
    assert spark.read.parquet(os.path.join(scratch, "audit")).agg(F.sum("n_records")).first()[0] == recs.count()


def test_command_line_sentiment(spark, scratch, capsys):
    import json as _json
    from spindle.__main__ import main
    train = _write_lines(derived.csv_lines_layout_b(spark, SF001), os.path.join(scratch, "cl_train"))
    test = _write_lines(derived.csv_lines_layout_a(spark, SF001), os.path.join(scratch, "cl_test"))
    main(["sentiment", "--train", train, "--test", test, "--iterations", "5"])
    out = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert 0 <= out["auc"]["auc"] <= 1 and out["accuracy"]["n_test"] == 87


def test_word_count_stream_update_mode(spark, scratch):
    src = os.path.join(scratch, "w")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("to be or  not to be\n")
    q = jobs.word_count_stream(spark.readStream.text(src), "wc_upd", sink="memory", mode="update",
                               trigger={"availableNow": True}, checkpoint_location=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    assert {r.word: r.n for r in spark.sql("select * from wc_upd").collect()} == \
        {"to": 2, "be": 2, "or": 1, "": 1, "not": 1}


def test_score_stream_matches_batch_scoring(spark, scratch):
    from spindle.operators import models
    from spindle.operators.setops import hash_split
    lab = derived.labelled_docs(spark, SF001)
    train, test = hash_split(lab, "doc_id", 0.6)
    model = models.fit(models.svm_pipeline(max_iter=5), train)
    src = os.path.join(scratch, "new")
    os.makedirs(src)
    texts = ["a joy to watch", "so sad today", "great film"]
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(texts) + "\n")
    q = jobs.score_stream(spark.readStream.text(src), model, "scored_t", sink="memory",
                          trigger={"availableNow": True}, checkpoint_location=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    got = {r.sentence: round(r.score, 9) for r in spark.sql("select * from scored_t").collect()}
    batch = models.svm_scores(model, spark.createDataFrame([(t, 0.0) for t in texts], "sentence string, label double"),
                              keep=["sentence"])
    assert got == {r.sentence: round(r.score, 9) for r in batch.collect()}


def test_command_line_bounded_sensor_run(spark, scratch):
    from spindle.__main__ import main
    src = os.path.join(scratch, "cl_sensor")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("11111111-1111-1111-1111-111111111111,70,2\n")
    main(["sensor", "--input", src, "--interval", "1 second", "--seconds", "5",
          "--checkpoint", os.path.join(scratch, "cl_ck")])
    assert not [q for q in spark.streams.active if q.name == "sensor"]


def test_tweets_to_table_keyed_by_tweet_id(spark, scratch):
    recs = derived.kafka_records(spark, SF001)
    src = os.path.join(scratch, "recs2")
    recs.write.parquet(src)
    stream = spark.readStream.schema(recs.schema).parquet(src)
    table_path = os.path.join(scratch, "table2")
    q = jobs.tweets_to_table(stream, table_path, trigger={"availableNow": True},
                             checkpoint_location=os.path.join(scratch, "ck2"), key="id_str")
    q.awaitTermination(300)
    table = KeyedTable(table_path, "id_str", ["timestamp", "offset"], ["key", "created_at", "text"])
    assert table.read(spark).count() == recs.count()   # one row per tweet

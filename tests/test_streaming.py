"""Streams replayed from numbered files equal the batch replay forms; restart
from the checkpoint continues the state."""

import os

from pyspark.sql import functions as F

from spindle.plans import derived
from spindle.plans.queries import sensor_running_avg, track_running_totals
from spindle.sinks.keyed_table import KeyedTable
from spindle.streaming.control import start, stop_gracefully
from spindle.streaming.keyed import tweets_from_records, upsert_batch_fn
from spindle.streaming.sensor import sensor_state_stream
from spindle.streaming.wordcount import running_word_counts
from tests.conftest import SF001


def _write_batches(df, base, batch_col, n_batches):
    """One parquet folder per batch value, named in order, for file-stream replay."""
    batches = [r[0] for r in df.select(batch_col).distinct().orderBy(batch_col).limit(n_batches).collect()]
    for i, b in enumerate(batches):
        df.filter(F.col(batch_col) == F.lit(b)).drop(batch_col).coalesce(1) \
            .write.mode("overwrite").parquet(os.path.join(base, f"part-{i:05d}"))
    return batches


def _stage_files(base):
    """Move folder outputs into one folder of files (file source reads a folder)."""
    out = os.path.join(base, "stream")
    os.makedirs(out, exist_ok=True)
    for d in sorted(os.listdir(base)):
        if not d.startswith("part-"):
            continue
        for f in sorted(os.listdir(os.path.join(base, d))):
            if f.endswith(".parquet"):
                os.link(os.path.join(base, d, f), os.path.join(out, f"{d}-{f}"))
    return out


def test_sensor_stream_equals_replay(spark, scratch):
    readings = derived.sensor_readings(spark, SF001).select("session_id", "batch", "heart_rate", "calorie")
    batches = _write_batches(readings, scratch, "batch", 24)
    src = _stage_files(scratch)
    schema = "session_id bigint, heart_rate int, calorie int"
    for track, name, replay in [(True, "sensor_t", sensor_running_avg), (False, "track_t", track_running_totals)]:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = start(sensor_state_stream(stream, track_count=track), name, "update",
                  sink="memory", trigger={"availableNow": True},
                  checkpoint_location=os.path.join(scratch, f"ckpt-{name}"))
        q.awaitTermination(300)
        got = spark.sql(f"select * from {name}")
        # the memory sink keeps every emitted row: the latest per key is the state
        want = replay(spark, SF001).filter(F.col("batch") <= F.lit(batches[-1]))
        cols = [c for c in got.columns]
        # compare the full history: stream rows per (key, batch) in emission order
        assert got.count() == want.count()
        assert sorted(tuple(r) for r in got.select(*cols).collect()) == \
            sorted(tuple(r) for r in want.select(*cols).collect())


def test_word_count_restart_keeps_counts(spark, scratch):
    src = os.path.join(scratch, "lines")
    os.makedirs(src)
    ckpt = os.path.join(scratch, "ckpt-wc")
    with open(os.path.join(src, "f0.txt"), "w") as f:
        f.write("to be or  not\nto be\n")
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    q = start(running_word_counts(lines), "wc1", "complete", trigger={"availableNow": True},
              checkpoint_location=ckpt)
    q.awaitTermination(120)
    first = {r.word: r.n for r in spark.sql("select * from wc1").collect()}
    assert first == {"to": 2, "be": 2, "or": 1, "": 1, "not": 1}
    with open(os.path.join(src, "f1.txt"), "w") as f:
        f.write("be quick\n")
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    q = start(running_word_counts(lines, sort=True), "wc2", "complete", trigger={"availableNow": True},
              checkpoint_location=ckpt)
    q.awaitTermination(120)
    rows = spark.sql("select * from wc2").collect()
    assert {r.word: r.n for r in rows} == {"to": 2, "be": 3, "or": 1, "": 1, "not": 1, "quick": 1}
    assert rows[0].word == "be"  # sorted by count in complete mode


def test_keyed_table_upsert_is_idempotent(spark, scratch):
    recs = derived.kafka_records(spark, SF001)
    tweets = tweets_from_records(recs)
    table = KeyedTable(os.path.join(scratch, "kt"), "key", ["timestamp", "offset"], ["created_at"])
    fn = upsert_batch_fn(table, audit_path=os.path.join(scratch, "audit"))
    half = tweets.filter(F.col("offset") < 3000)
    fn(half, 0)
    fn(tweets.filter(F.col("offset") >= 3000), 1)
    fn(tweets.filter(F.col("offset") >= 3000), 1)  # replayed batch: no change
    got = {r.key: r.created_at for r in table.read(spark).collect()}
    want = {r.key: r.created_at for r in tweets.groupBy("key").agg(
        F.max(F.struct("timestamp", "offset", "created_at")).alias("s")).select("key", "s.created_at").collect()}
    assert got == want
    audit = spark.read.parquet(os.path.join(scratch, "audit"))
    assert audit.agg(F.sum("n_records")).first()[0] == tweets.count()
    table.compact(spark, 1)
    assert {r.key: r.created_at for r in table.read(spark).collect()} == want


def test_stop_gracefully(spark, scratch):
    src = os.path.join(scratch, "lines2")
    os.makedirs(src)
    with open(os.path.join(src, "f0.txt"), "w") as f:
        f.write("a b\n")
    q = start(running_word_counts(spark.readStream.text(src)), "wc3", "complete",
              trigger={"processingTime": "1 second"}, checkpoint_location=os.path.join(scratch, "c3"))
    stop_gracefully(q, drain=True)
    assert not q.isActive
    assert {r.word for r in spark.sql("select * from wc3").collect()} == {"a", "b"}


def test_sliding_stream_and_progress_offsets(spark, scratch):
    from spindle.operators.offsets import offsets_from_progress
    from spindle.operators.sliding import sliding_counts
    from spindle.streaming.sliding import sliding_counts_stream
    ev = spark.read.parquet(f"{SF001}/events.parquet").select("ts", "event_type")
    src = os.path.join(scratch, "ev")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    q = start(sliding_counts_stream(stream, "ts", "event_type", "5 minutes", "1 minute", watermark=None),
              "slide_t", "complete", trigger={"availableNow": True},
              checkpoint_location=os.path.join(scratch, "ckpt-slide"))
    q.awaitTermination(300)
    got = spark.sql("select * from slide_t")
    want = sliding_counts(ev, "ts", "event_type", 300, 60)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    ranges = offsets_from_progress([p for p in q.recentProgress])
    assert ranges and all(r[3] is not None for r in ranges)


def test_sensor_stream_remove_on_reset(spark, scratch):
    rows = [("k", 70, 2), ("k", 80, 4)], [("k", -1, -1)], [("k", 90, 6)]
    src = os.path.join(scratch, "sens")
    for i, batch in enumerate(rows):
        spark.createDataFrame(batch, "session_id string, heart_rate int, calorie int").coalesce(1) \
            .write.mode("overwrite").parquet(os.path.join(src + "-parts", f"b{i}"))
    os.makedirs(src)
    for i in range(len(rows)):
        d = os.path.join(src + "-parts", f"b{i}")
        for f in os.listdir(d):
            if f.endswith(".parquet"):
                os.link(os.path.join(d, f), os.path.join(src, f"b{i}-{f}"))
    stream = spark.readStream.schema("session_id string, heart_rate int, calorie int") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    q = start(sensor_state_stream(stream, track_count=True, on_reset="remove"), "sens_rm", "update",
              trigger={"availableNow": True}, checkpoint_location=os.path.join(scratch, "ckpt-rm"))
    q.awaitTermination(300)
    got = [(r.total_hr, r.total_cal, r.total_n) for r in spark.sql("select * from sens_rm").collect()]
    # after the end marker the state is gone, so the next batch starts from zero (no phantom count)
    assert sorted(got) == sorted([(150, 6, 2), (0, 0, 1), (90, 6, 1)])


def test_sensor_stream_restart_keeps_state(spark, scratch):
    """Stop after batch 0, start again on the same checkpoint: state continues."""
    src = os.path.join(scratch, "s")
    os.makedirs(src)
    ckpt = os.path.join(scratch, "ckpt-restart")
    schema = "session_id string, heart_rate int, calorie int"

    def add(i, rows):
        part = os.path.join(scratch, f"p{i}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(part)
        for f in os.listdir(part):
            if f.endswith(".parquet"):
                os.link(os.path.join(part, f), os.path.join(src, f"b{i}-{f}"))

    out = os.path.join(scratch, "out")

    def write(batch, batch_id):  # idempotent per batch id
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out))

    def run(name):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = start(sensor_state_stream(stream), name, "update", trigger={"availableNow": True},
                  checkpoint_location=ckpt, foreach_batch=write)
        q.awaitTermination(300)
        return [(r.batch_id, r.total_hr, r.total_cal, r.total_n, r.avg_hr, r.avg_cal)
                for r in spark.read.parquet(out).orderBy("batch_id").collect()]

    add(0, [("k", 70, 2), ("k", 80, 4)])
    assert run("rs0") == [(0, 150, 6, 2, 75, 3)]
    add(1, [("k", 60, 3)])
    assert run("rs1") == [(0, 150, 6, 2, 75, 3), (1, 210, 9, 3, 70, 3)]


def test_sliding_stream_pre_aggregated(spark, scratch):
    from spindle.operators.sliding import sliding_counts
    from spindle.streaming.sliding import sliding_counts_stream
    ev = spark.read.parquet(f"{SF001}/events.parquet").select("ts", "event_type")
    src = os.path.join(scratch, "ev2")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    q = start(sliding_counts_stream(stream, "ts", "event_type", "5 minutes", "1 minute", watermark="10 minutes",
                                    pre_aggregate=True),
              "slide_pre", "append", trigger={"availableNow": True},
              checkpoint_location=os.path.join(scratch, "ckpt-slide-pre"))
    q.awaitTermination(300)
    got = spark.sql("select cast(window_start as timestamp_ntz) window_start, "
                    "cast(window_end as timestamp_ntz) window_end, event_type, n from slide_pre")
    want = sliding_counts(ev, "ts", "event_type", 300, 60)
    assert got.exceptAll(want).count() == 0          # every emitted window is exact
    # windows still open at the end of the input (watermark not past them) are not emitted yet
    horizon = ev.agg(F.max("ts")).first()[0]
    closed = want.filter(F.col("window_end") <= F.lit(horizon) - F.expr("INTERVAL 10 MINUTES"))
    assert closed.exceptAll(got).count() == 0


def test_unparseable_records_go_to_rejects(spark, scratch):
    recs = spark.createDataFrame(
        [("u1", '{"id_str":"1","created_at":"Mon","text":"hi"}', "t", 0, 1, None),
         ("u2", "not json", "t", 0, 2, None),
         (None, '{"id_str":"3","created_at":"Wed","text":"x"}', "t", 0, 3, None)],
        "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    tweets = tweets_from_records(recs)
    table = KeyedTable(os.path.join(scratch, "kt2"), "key", ["timestamp", "offset"], ["created_at"])
    upsert_batch_fn(table)(tweets, 0)
    assert [(r.key, r.created_at) for r in table.read(spark).collect()] == [("u1", "Mon")]
    rej = spark.read.parquet(os.path.join(scratch, "kt2", "rejects"))
    assert sorted(r.offset for r in rej.collect()) == ["2", "3"]


def test_marker_session_stream_equals_batch(spark, scratch):
    from spindle.operators.sessions import marker_sessions
    from spindle.streaming.sensor import marker_session_stream
    readings = derived.sensor_readings(spark, SF001).select(
        "session_id", "batch", "ts", "event_id", "heart_rate", "calorie", "is_marker")
    batches = _write_batches(readings, scratch, "batch", 30)
    src = _stage_files(scratch)
    schema = "session_id bigint, ts timestamp_ntz, event_id bigint, heart_rate int, calorie int, is_marker boolean"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = start(marker_session_stream(stream), "marker_t", "update", trigger={"availableNow": True},
              checkpoint_location=os.path.join(scratch, "ckpt-marker"))
    q.awaitTermination(300)
    emitted = spark.sql("select * from marker_t")
    cols = ["n", "total_hr", "total_cal", "avg_hr", "avg_cal"]
    final = (emitted.groupBy("session_id", "session_no")
             .agg(F.max(F.struct("closed", *cols)).alias("s"))
             .select("session_id", "session_no", *[F.col(f"s.{c}").alias(c) for c in cols], "s.closed"))
    want = marker_sessions(readings.filter(F.col("batch") <= F.lit(batches[-1])))
    assert sorted(tuple(r) for r in final.collect()) == \
        sorted(tuple(r) for r in want.select(*final.columns).collect())

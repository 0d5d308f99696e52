"""Stream runs over delivered batches: what a stop between two writes leaves
visible, what a start without new data changes, what the sliding state holds."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from spindle.operators.sliding import sliding_counts
from spindle.sinks.commits import Commits
from spindle.sinks.keyed_table import KeyedTable
from spindle.streaming.keyed import AUDIT_SCHEMA, upsert_batch_fn
from spindle.streaming.replay import ROCKSDB, Run
from spindle.streaming.sessions import closed_sessions_stream
from spindle.streaming.sliding import sliding_changes_stream

RECORDS = "key string, offset bigint, topic string, partition int, v string, batch int"


def records(spark):
    rows = [(f"k{i % 7}", i, "t", i % 2, f"v{i}", i // 10) for i in range(60)]
    return spark.createDataFrame(rows, RECORDS)


def test_a_stopped_batch_shows_in_neither_table(spark, scratch):
    run = Run(records(spark), "batch", lambda rows: rows, "stopped", "append", path=f"{scratch}/run")
    table = KeyedTable(f"{scratch}/table", "key", ["offset"], ["v"], Commits(f"{scratch}/commits"))
    audit = f"{scratch}/audit"

    def stop(batch_id):
        if batch_id == 3:
            raise RuntimeError("between the writes")

    run.sink = upsert_batch_fn(table, audit, between=stop)
    run.delivery.deliver(spark, 0, 6)
    with pytest.raises(StreamingQueryException, match="between the writes"):
        run.start()
    seen = {r.key: r.v for r in table.read(spark).collect()}
    assert seen == {f"k{k}": f"v{max(i for i in range(30) if i % 7 == k)}" for k in range(7)}
    assert sorted({r.batch_id for r in table.commits.read(spark, audit, AUDIT_SCHEMA).collect()}) == [0, 1, 2]
    # The upsert of batch 3 is on disk, but not visible.
    assert spark.read.parquet(f"{scratch}/table/data").where("batch_id = 3").count() > 0

    run.sink = upsert_batch_fn(table, audit)
    assert run.start() == 3  # batch 3 again, 4 and 5
    assert {r.key: r.v for r in table.read(spark).collect()} == {f"k{k}": f"v{max(i for i in range(60) if i % 7 == k)}" for k in range(7)}
    ranges = table.commits.read(spark, audit, AUDIT_SCHEMA)
    assert ranges.agg(F.sum("n_records")).first()[0] == 60
    assert sorted((r.batch_id, r.partition, r.from_offset, r.until_offset) for r in ranges.collect()) == [
        (b, p, 10 * b + p, 10 * b + 9 + p) for b in range(6) for p in range(2)]
    assert run.start() == 0  # nothing new


def test_micro_batches_are_the_delivered_batches(spark, scratch):
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else i % 5) for i in range(50)], "x bigint, batch int")
    run = Run(rows, "batch", lambda r: r, "delivered", "append", path=f"{scratch}/run").all(starts=3)
    assert sorted(run.result("x bigint").collect(), key=str) == sorted(rows.collect(), key=str)


def test_nothing_to_deliver(spark, scratch):
    rows = spark.createDataFrame([], "x bigint, batch int")
    run = Run(rows, "batch", lambda r: r, "empty", "append", path=f"{scratch}/run").all()
    assert run.result("x bigint").count() == 0 and run.result("x bigint", by_batch=False).count() == 0


def test_sliding_state_holds_a_row_for_each_slide(spark, scratch):
    """Each event once in the state, however many windows hold it; windows equal the
    batch form; null keys, gaps and equal times included."""
    r = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=r.randint(0, 900), microseconds=r.randint(0, 999_999)), r.choice(["a", "b", None])) for _ in range(300)]
    rows += [(start + dt.timedelta(seconds=4000 + i % 3), "a") for i in range(50)] + [(start + dt.timedelta(seconds=9000), "z")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, k string").withColumn("batch", F.floor(F.minute("ts") / 5 + F.hour("ts") * 12).cast("int"))
    run = Run(df, "batch", lambda s: sliding_changes_stream(s, "ts", "k", 120, 2, "10 seconds"), "slides", "append",
              settings={"spark.sql.streaming.stateStore.providerClass": ROCKSDB}, path=f"{scratch}/run")
    half = run.delivery.count // 2
    run.delivery.deliver(spark, 0, half)
    run.start()
    state = run.session.read.format("statestore").option("operatorId", 0).option("stateVarName", "buckets").load(run.checkpoint)
    held = state.count()
    latest = df.where(F.col("batch").isin([b.batch for b in run.delivery.manifest.where(f"batch_no < {half}").collect()]))
    open_after = latest.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=10 + 120 + 4)
    recent = latest.where(F.col("ts") >= F.lit(open_after)).select("k", F.window(F.col("ts").cast("timestamp"), "2 seconds")).distinct().count()
    assert 0 < held <= recent  # not 60 times the events
    run.delivery.deliver(spark, half, run.delivery.count)
    run.start()
    got = run.result("window_start timestamp_ntz, window_end timestamp_ntz, k string, n bigint", by_batch=False)
    last = start + dt.timedelta(seconds=9000 - 10)
    want = sliding_counts(df, "ts", "k", 120, 2).where(F.col("window_end") <= F.lit(last))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(got.columns).collect()), key=str)


def test_sessions_do_not_depend_on_the_cut_in_batches(spark, scratch):
    """Rows that arrive out of order within the watermark's delay, in any batches."""
    r = random.Random(8)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for key in (1, 2, None):
        at = 0
        for i in range(60):
            at += r.choice([0, 5, 20, 200])
            rows.append((key, start + dt.timedelta(seconds=at), len(rows), r.choice([None, 60, 70]), i, r.random() < 0.1, (at + r.randint(0, 50)) // 600))
    rows.append((9, start + dt.timedelta(days=1), 10_000, 1, 1, False, 10_000))  # the watermark passes all others
    df = spark.createDataFrame(rows, "session_id bigint, ts timestamp_ntz, event_id bigint, heart_rate int, calorie int, is_marker boolean, batch int")
    schema = ("session_id bigint, session_no bigint, first_ts timestamp_ntz, last_ts timestamp_ntz, n bigint, total_hr bigint, total_cal bigint, "
              "closed_by string")
    found = []
    for name, cut in (("many", df), ("one", df.withColumn("batch", F.lit(0)))):
        run = Run(cut, "batch", lambda s: closed_sessions_stream(s, 100, watermark="60 seconds"), f"sessions_{name}", "append",
                  settings={"spark.sql.streaming.stateStore.providerClass": ROCKSDB}, path=f"{scratch}/{name}").all()
        found.append(sorted(map(tuple, run.result(schema, by_batch=False).collect()), key=str))
    assert found[0] == found[1] and {s[0] for s in found[0]} == {1, 2, None}
    assert sum(s[4] for s in found[0]) == sum(not m for *_, m, _ in rows) - 1
    assert {s[7] for s in found[0]} == {"idle", "marker"}

"""What keeps the stream runs within their input's growth: state by groups of keys
and by ranges of time, files by the largest batch, a bounded number of batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spindle.operators.sliding import sliding_counts
from spindle.plans.streams import _stretches
from spindle.streaming import replay
from spindle.streaming.groups import STATE_GROUPS
from spindle.streaming.replay import ROCKSDB, Run
from spindle.streaming.sensor import sensor_state_stream, sensor_states
from spindle.streaming.sessions import closed_sessions_stream
from spindle.streaming.sliding import sliding_changes_stream

SETTINGS = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
BIG = 2**53 + 1  # no whole number of floating point
KEYS = 2 * STATE_GROUPS
START = dt.datetime(2024, 1, 1)


def plainly(rows) -> list[tuple]:
    return sorted(map(tuple, rows), key=str)


def test_sensor_state_rows_do_not_grow_with_the_sessions(spark, scratch):
    keys = [None, BIG, *range(KEYS)]
    rows = [(k, 60 + b, None if b == 1 else b, b) for b in range(3) for k in keys] + [(BIG, -60 - 3 - 1, -4, 3), (BIG, 60 + 3, 3, 3), (None, -1, -1, 3)]
    df = spark.createDataFrame(rows, "session_id bigint, heart_rate int, calorie int, batch int")
    run = Run(df, "batch", sensor_state_stream, "groups", path=f"{scratch}/run").all()
    totals = "session_id bigint, total_hr bigint, total_cal bigint, total_n bigint, avg_hr bigint, avg_cal bigint"
    want = [(k, sum(60 + x for x in range(b + 1)), (0, 0, 2)[b], b + 1, sum(60 + x for x in range(b + 1)) // (b + 1), (0, 0, 0)[b], b)
            for b in range(3) for k in keys] + [(k, 0, 0, 1, 0, 0, 3) for k in (BIG, None)]
    assert plainly(run.result(totals).collect()) == plainly(want)
    state = run.session.read.format("statestore").load(run.checkpoint)
    assert state.count() <= STATE_GROUPS
    last = [(k, 0, 0, 1) if k in (BIG, None) else (k, 183, 2, 3) for k in keys]
    assert plainly(sensor_states(state, "bigint").collect()) == plainly(last)


@pytest.mark.parametrize("most", [1, 40])
def test_a_small_batch_beside_a_large_one_has_as_many_files(spark, scratch, monkeypatch, most):
    monkeypatch.setattr(replay, "FILE_ROWS", 100 // most)
    df = spark.createDataFrame([(i, 0 if i == 0 else 1 + i // 100) for i in range(300)] + [(300, None)], "x bigint, batch int")
    run = Run(df, "batch", lambda rows: rows, "files", "append", path=f"{scratch}/run").all()
    assert run.delivery.files >= most
    assert plainly(run.result("x bigint").collect()) == plainly(df.collect())


def test_sliding_state_is_a_row_for_each_range(spark, scratch):
    """A key with an event each second, over the cut of two ranges; then the rest."""
    rows = [(START + dt.timedelta(seconds=s), k, int(s >= 4000)) for s in range(3000, 5000) for k in ("a", None) if s % 7 or k]
    df = spark.createDataFrame([*rows, (START + dt.timedelta(days=1), "z", 1)], "ts timestamp_ntz, k string, batch int")
    run = Run(df, "batch", lambda s: sliding_changes_stream(s, "ts", "k", 300, 1, "10 seconds"), "ranges", "append",
              settings=SETTINGS, path=f"{scratch}/run")
    run.delivery.deliver(spark, 0, 1)
    run.start()
    state = run.session.read.format("statestore").option("operatorId", 0).option("stateVarName", "buckets").load(run.checkpoint)
    assert 0 < state.count() <= 4  # not the 300 open buckets of each key
    run.delivery.deliver(spark, 1, 2)
    run.start()
    got = run.result("window_start timestamp_ntz, window_end timestamp_ntz, k string, n bigint", by_batch=False)
    want = sliding_counts(df.where("k IS DISTINCT FROM 'z'"), "ts", "k", 300, 1)
    assert plainly(got.collect()) == plainly(want.select(got.columns).collect())


def test_session_state_rows_do_not_grow_with_the_keys(spark, scratch):
    keys = [None, BIG, *range(KEYS)]
    rows = [(k, START + dt.timedelta(seconds=s), s, 60, None, s == 20, s // 30) for k in keys for s in (0, 10, 20, 30)]
    df = spark.createDataFrame([*rows, (7, START + dt.timedelta(days=1), 99, 1, 1, None, 2)],
                               "session_id bigint, ts timestamp_ntz, event_id bigint, heart_rate int, calorie int, is_marker boolean, batch int")
    run = Run(df, "batch", lambda s: closed_sessions_stream(s, 100, watermark="5 seconds"), "groups", "append", settings=SETTINGS,
              path=f"{scratch}/run").all()
    state = run.session.read.format("statestore").option("operatorId", 0).option("stateVarName", "open").load(run.checkpoint)
    assert 0 < state.count() <= STATE_GROUPS
    got = run.result("session_id bigint, session_no bigint, n bigint, total_hr bigint, total_cal bigint, closed_by string", by_batch=False)
    assert plainly(got.collect()) == plainly([(k, *s) for k in keys for s in ((0, 2, 120, 0, "marker"), (1, 1, 60, 0, "idle"))])


def test_batches_of_a_long_table_are_few(spark):
    days = spark.createDataFrame([(START + dt.timedelta(days=i),) for i in range(3000)], "ts timestamp_ntz")
    assert 5 <= days.select(_stretches(days, "ts", 5 * 86400, 8)).distinct().count() <= 9
    month = days.limit(30)
    assert month.select(_stretches(month, "ts", 5 * 86400, 8)).distinct().count() == 7
    none = days.where(F.lit(False))
    assert none.select(_stretches(none, "ts", 5 * 86400, 8)).count() == 0

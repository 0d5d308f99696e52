"""Running state with reset rules: goldens, and the chunked scan against the
single-window scan and a plain Python replay."""

import random

from pyspark.sql import functions as F

from spindle.functions.scalars import int_div
from spindle.operators.running import running_totals, state_as_of


def _sensor(spark, rows, track_count=True, chunk=None):
    df = spark.createDataFrame(rows, "k string, batch long, hr long, cal long")
    per = df.groupBy("k", "batch").agg(F.sum("hr").alias("hr"), F.sum("cal").alias("cal"),
                                       F.count(F.lit(1)).alias("n"))
    reset = (F.col("hr") == -1) & (F.col("cal") == -1)
    vals = ["hr", "cal", "n"] if track_count else ["hr", "cal"]
    out = running_totals(per, "k", "batch", vals, reset=reset, reset_values={"n": 1}, prefix="t_",
                         chunk=chunk)
    return out.orderBy("batch")


GOLDEN = [("k", 0, 70, 2), ("k", 0, 80, 4), ("k", 1, 60, 3), ("k", 2, -1, -1), ("k", 3, 90, 6),
          ("k", 4, -1, -1), ("k", 4, 10, 1)]


def test_sensor_golden(spark):
    out = _sensor(spark, GOLDEN).select("batch", "t_hr", "t_cal", "t_n",
                                        int_div("t_hr", "t_n").alias("ah"), int_div("t_cal", "t_n").alias("ac"))
    got = [tuple(r) for r in out.collect()]
    assert [g[1:4] for g in got] == [(150, 6, 2), (210, 9, 3), (0, 0, 1), (90, 6, 2), (99, 6, 4)]
    assert [g[4:] for g in got][:4] == [(75, 3), (70, 3), (0, 0), (45, 3)]


def test_track_golden(spark):
    got = [(r.t_hr, r.t_cal) for r in _sensor(spark, GOLDEN, track_count=False).collect()]
    assert got[:4] == [(150, 6), (210, 9), (0, 0), (90, 6)]


def _replay(rows):
    """Plain Python fold of the batch-sum rule, for comparison."""
    out = {}
    for k in sorted({r[0] for r in rows}):
        st = (0, 0, 0)
        for b in sorted({r[1] for r in rows if r[0] == k}):
            hs = sum(r[2] for r in rows if r[0] == k and r[1] == b)
            cs = sum(r[3] for r in rows if r[0] == k and r[1] == b)
            n = sum(1 for r in rows if r[0] == k and r[1] == b)
            st = (0, 0, 1) if (hs == -1 and cs == -1) else (st[0] + hs, st[1] + cs, st[2] + n)
            out[(k, b)] = st
    return out


def test_chunked_scan_matches_replay(spark):
    rnd = random.Random(7)
    rows = []
    for k in ["a", "b", "hot"]:
        for b in range(60 if k != "hot" else 400):
            for _ in range(rnd.randint(1, 3)):
                rows.append((k, b, -1, -1) if rnd.random() < 0.15 else (k, b, rnd.randint(40, 120), rnd.randint(0, 9)))
    want = _replay(rows)
    for chunk in (None, F.floor(F.col("batch") / 7), F.floor(F.col("batch") / 50)):
        got = {(r.k, r.batch): (r.t_hr, r.t_cal, r.t_n) for r in _sensor(spark, rows, chunk=chunk).collect()}
        assert got == want


def test_state_as_of(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("b", 2, 5), ("b", 5, 7)], "k string, b long, v long")
    got = {r.k: (r.b, r.v) for r in state_as_of(df, "k", "b", 4).collect()}
    assert got == {"a": (3, 30), "b": (2, 5)}

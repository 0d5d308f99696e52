"""Sliding windows cut into ranges of time: any range gives the same windows, and no
task holds the whole time of a key."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from spindle.operators.sliding import sliding_counts

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    r = random.Random(9)
    rows = [(START + dt.timedelta(seconds=r.randint(0, 3000)), "hot", r.randint(0, 5)) for _ in range(400)]
    rows += [(START + dt.timedelta(seconds=50_000 + 40 * i), "hot", 1) for i in range(60)]     # a gap, then a run over many ranges
    rows += [(START + dt.timedelta(seconds=7), None, 2), (START + dt.timedelta(seconds=7), None, 3), (None, "hot", 9), (START, "one", None)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, k string, v int")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_ranges_of_any_length_give_the_same(events):
    plain = events.where("ts IS NOT NULL").groupBy(F.window("ts", "60 seconds", "2 seconds").alias("w"), "k") \
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("sum_v")) \
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "k", "n", "sum_v")
    want = rows_of(plain)
    for seconds in (1, 60, 62, 100, 3600, 10 ** 6):
        got = sliding_counts(events, "ts", "k", 60, 2, value="v", range_seconds=seconds)
        assert rows_of(got.withColumn("sum_v", F.coalesce("sum_v", F.lit(0)))) == want


def test_a_hot_key_is_many_groups(spark, events):
    """Sums and fill-in are grouped by (key, range), nothing by the key alone."""
    plan = sliding_counts(events, "ts", "k", 60, 2, range_seconds=60)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "+- Window" in line or " Window [" in line]
    assert windows and all("_range" in w for w in windows)
    alone = re.findall(r"Exchange hashpartitioning\(k#\d+, \d+\)", plan)
    assert not alone

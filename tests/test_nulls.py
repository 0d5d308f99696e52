"""Null keys and times stay; splits are linear; samples do not depend on the plan."""

import datetime as dt
import time

import duckdb
from pyspark.sql import functions as F

from spindle.functions.scalars import bucket_start
from spindle.functions.text import java_split, tokenize
from spindle.operators.running import running_totals
from spindle.plans.queries import QUERIES
from spindle.sources.tables import SPREAD_SETTING
from tests.conftest import SF001

T0 = dt.datetime(2024, 3, 1, 23, 59, 59, 999_999)


def test_running_totals_keep_null_keys_and_orders(spark):
    rows = [("a", 1, 5), ("a", None, 7), (None, 2, 1), (None, None, 3), (None, 90, -1), ("a", 95, 2), ("a", 40, -1)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    reset = F.col("v") == -1
    whole = running_totals(df, "k", "o", ["v"], reset=reset, prefix="t_")
    cut = running_totals(df, "k", "o", ["v"], reset=reset, prefix="t_", chunk=F.floor(F.col("o") / 10))
    key = lambda r: tuple((x is not None, x) for x in r)
    got = [sorted((tuple(r) for r in x.select("k", "o", "v", "t_v").collect()), key=key) for x in (whole, cut)]
    con = duckdb.connect()
    con.execute("CREATE TABLE r (k VARCHAR, o INT, v INT)")
    con.executemany("INSERT INTO r VALUES (?, ?, ?)", rows)
    want = con.execute("""
        WITH e AS (SELECT *, sum((v = -1)::INT) OVER (PARTITION BY k ORDER BY o NULLS FIRST) AS e FROM r)
        SELECT k, o, v, sum(CASE WHEN v = -1 THEN 0 ELSE v END) OVER (PARTITION BY k, e ORDER BY o NULLS FIRST)::BIGINT FROM e""").fetchall()
    assert got[0] == got[1] == sorted(want, key=key)


def test_bucket_start_keeps_nulls_and_type(spark):
    df = spark.createDataFrame([(T0,), (None,), (dt.datetime(1969, 12, 31, 23, 0, 1),)], "ts timestamp_ntz")
    out = df.select("ts", *[bucket_start("ts", s).alias(f"b{s}") for s in (60, 3600, 86400, 7 * 86400)])
    assert dict(out.dtypes)["b60"] == "timestamp_ntz"
    rows = {r.ts: r for r in out.collect()}
    assert rows[None].b3600 is None
    r = rows[T0]
    assert (r.b60, r.b3600, r.b86400) == (T0.replace(second=0, microsecond=0), T0.replace(minute=0, second=0, microsecond=0), dt.datetime(2024, 3, 1))
    assert r.b604800 == dt.datetime(2024, 2, 29)
    assert rows[dt.datetime(1969, 12, 31, 23, 0, 1)].b3600 == dt.datetime(1969, 12, 31, 23)


def test_split_is_linear_in_runs_of_delimiters(spark):
    text = "a" + " " * 1_000_000 + "b" + " " * 1_000
    df = spark.createDataFrame([(text,)], "t string").cache()
    df.count()
    df.select(F.size(java_split("t"))).collect()
    t = time.time()
    n, m = df.select(F.size(java_split("t")), F.size(tokenize("t"))).first()
    assert n == m == 1_000_001 and time.time() - t < 5


def test_split_by_several_characters(spark):
    cases = {"": [""], "||": [], "a||b||||": ["a", "b"], "||a": ["", "a"], "a|": ["a|"], "a||||b": ["a", "", "b"]}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    got = {r.t: r.p for r in df.select("t", java_split("t", "||").alias("p")).collect()}
    assert got == {**cases, None: None}


def test_sample_does_not_depend_on_layout_or_join(spark):
    want = sorted(r.doc_id for r in QUERIES["sample_60"](spark, SF001).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for n in ("2", "5"):
            spark.conf.set(SPREAD_SETTING, n)
            assert sorted(r.doc_id for r in QUERIES["sample_60"](spark, SF001).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset(SPREAD_SETTING)

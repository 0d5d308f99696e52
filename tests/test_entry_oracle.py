"""Driver contract: entry() runs; every SQL-checkable query equals its DuckDB
twin on the smallest data set (same compare as tools/oracle_check.py)."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from spindle.operators.sliding import sliding_counts
from spindle.sources.tables import TABLES
from tests.conftest import SF001
from tools.oracle_check import digest


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.limit(5).collect()
    assert df.columns == ["n", "word"] and len(rows) == 5
    assert rows[0].n >= rows[-1].n


def test_registry_shape():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 29


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_sliding_equals_plain_window(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ours = sliding_counts(ev, "ts", "event_type", 300, 60)
    plain = ev.groupBy(F.window("ts", "5 minutes", "1 minute").alias("w"), "event_type").count() \
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type",
                F.col("count").alias("n"))
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0

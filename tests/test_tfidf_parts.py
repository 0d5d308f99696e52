"""TF-IDF groups texts in parts that fit a task, and joins without sorting (doc, term)."""

import pytest
from pyspark.sql import functions as F

from spindle.plans.queries import QUERIES
from spindle.sources.tables import PARTS_PER_SPLIT, SPREAD_SETTING, smaller_parts


@pytest.fixture()
def folder(spark, scratch):
    texts = [(1, "a b a"), (1, "a c"), (2, "b  c "), (3, None), (None, "c"), (4, "")]
    spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1).write.parquet(f"{scratch}/documents.parquet")
    return scratch


def test_a_split_is_grouped_in_parts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert smaller_parts(docs, "doc_id").rdd.getNumPartitions() == PARTS_PER_SPLIT * docs.rdd.getNumPartitions()
    plan = QUERIES["tfidf"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(xxhash64(doc_id" in plan
    spark.conf.set(SPREAD_SETTING, "3")
    try:
        assert smaller_parts(docs, "doc_id").rdd.getNumPartitions() == docs.rdd.getNumPartitions()
    finally:
        spark.conf.unset(SPREAD_SETTING)


def test_rows_are_joined_by_hash(spark, folder):
    df = QUERIES["tfidf"](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
    got = {(r.doc_id, r.term): r.tf for r in df.collect()}
    assert got == {(1, "a"): 3, (1, "b"): 1, (1, "c"): 1, (2, "b"): 1, (2, ""): 1, (2, "c"): 1, (None, "c"): 1, (4, ""): 1}
    assert df.where(F.col("tf") * F.col("idf") - F.col("tfidf") > 1e-5).count() == 0

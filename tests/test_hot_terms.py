"""One term in most rows: the TF-IDF join splits its partition."""

from pyspark.sql import functions as F

from spindle.operators.features import inverse_document_frequencies, tfidf

SETTINGS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}


def test_hot_term_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        term = F.when(F.col("id") % 5 < 4, F.lit("the")).otherwise(F.concat(F.lit("t"), (F.col("id") % 3000).cast("string")))
        tf = spark.range(300_000).select(F.col("id").alias("doc_id"), term.alias("term"), F.lit(1).cast("bigint").alias("tf"))
        out = tfidf(tf, inverse_document_frequencies(tf, F.lit(300_000.0)))
        assert out.count() == 300_000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)

"""JSON records with a declared schema (no per-batch inference job)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the tweet fields the keyed-table job reads.
TWEET_SCHEMA = T.StructType([
    T.StructField("id_str", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
])


def parse_json(c, schema: T.StructType | str = TWEET_SCHEMA) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col, schema, {"mode": "PERMISSIVE"})


def project_json(df: DataFrame, value: str = "value", schema: T.StructType | str = TWEET_SCHEMA,
                 fields: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """value (JSON text) -> selected top-level fields."""
    rec = parse_json(value, schema).alias("_rec")
    out = df.select(*(keep or []), rec)
    names = fields or [f.name for f in (schema.fields if isinstance(schema, T.StructType) else [])]
    if not names:
        return out.select(*(keep or []), "_rec.*")
    return out.select(*(keep or []), *[F.col(f"_rec.{n}").alias(n) for n in names])


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Batch JSON-lines read; pass a schema to skip the inference pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)

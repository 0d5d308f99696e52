"""Kafka -> JSON -> keyed table, and the per-batch offset audit."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.operators.offsets import offset_ranges
from spindle.sinks.keyed_table import KeyedTable
from spindle.sources.json import TWEET_SCHEMA, project_json
from spindle.sources.kafka import kafka_value


def tweets_from_records(records: DataFrame, schema: T.StructType = TWEET_SCHEMA) -> DataFrame:
    """Kafka rows -> declared JSON fields (+ key, offset, timestamp, and the
    raw `value`). `parsed` is false when the value is not a JSON record of the
    schema (every declared field null); such rows go to the reject table."""
    out = project_json(kafka_value(records), "value", schema,
                       keep=["key", "value", "topic", "partition", "offset", "timestamp"])
    parsed = reduce(lambda a, b: a | b, [F.col(f.name).isNotNull() for f in schema.fields])
    return out.withColumn("parsed", parsed)


# Columns of the offset audit, beside batch_id.
AUDIT_SCHEMA = "topic string, partition int, from_offset bigint, until_offset bigint, n_records bigint"


def upsert_batch_fn(table: KeyedTable, audit_path: str | None = None, between: Callable[[int], None] | None = None):
    """`foreachBatch` function: upsert the batch, and record its offset ranges.
    The batch is read and parsed once and kept until all three writes are done.
    If the table has commit records, the batch gets one after its last write, so
    that table and audit show it together or not at all. `between` is called with
    the batch number between the upsert and the audit (tests stop there)."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write(batch, batch_id)
            if table.commits is not None:
                table.commits.publish(batch.sparkSession, batch_id)
        finally:
            batch.unpersist()

    def write(batch: DataFrame, batch_id: int) -> None:
        if "parsed" in batch.columns:
            table.write_batch(batch.filter(F.col("parsed")).drop("parsed", "value"), batch_id,
                              extra_rejects=batch.filter(~F.col("parsed")).drop("parsed"))
        else:
            table.write_batch(batch, batch_id)
        if between is not None:
            between(batch_id)
        if audit_path:
            (offset_ranges(batch).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(audit_path))
    return fn

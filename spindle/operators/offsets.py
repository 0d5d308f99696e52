"""Offset audit: the offset range each batch read per topic partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def offset_ranges(records: DataFrame, by: list[str] | None = None, contiguous: bool = False) -> DataFrame:
    """`(…by, topic, partition, from_offset, until_offset, n_records)`;
    `until_offset` is exclusive, as in Kafka offset ranges.

    With `contiguous=True` (needs one ordered `by` column, the batch), a
    batch's `from_offset` is the previous batch's `until_offset` for the same
    partition, as a Kafka consumer reports it when offsets have gaps
    (compaction, transaction markers). That window runs over one row per
    (partition, batch), partitioned by topic partition."""
    out = (records.groupBy(*(by or []), "topic", "partition")
           .agg(F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"),
                F.count(F.lit(1)).alias("n_records")))
    if contiguous:
        if not by or len(by) != 1:
            raise ValueError("contiguous ranges need exactly one ordered batch column")
        w = Window.partitionBy("topic", "partition").orderBy(by[0])
        out = out.withColumn("from_offset", F.coalesce(F.lag("until_offset").over(w), F.col("from_offset")))
    return out


def offsets_from_progress(progress: list[dict]) -> list[tuple]:
    """Offset ranges reported by a streaming query (`query.recentProgress`):
    one `(batch_id, source, start, end)` tuple per source and batch. This is
    a handful of small dicts that Spark already keeps on the driver."""
    rows = []
    for p in progress:
        for s in p.get("sources", []):
            rows.append((p.get("batchId"), s.get("description"), s.get("startOffset"), s.get("endOffset")))
    return rows

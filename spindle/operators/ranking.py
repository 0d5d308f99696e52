"""Row numbers over one global order, without one task that holds it.

Rows are dealt out by ranges of the order and written with the number of their
range; a table with one row per range carries the counts across, and each range
numbers its own rows. The write fixes the ranges: both readers see the same ones,
whatever sampling or coalescing would give a second evaluation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ranked(df: DataFrame, order: list[Column], path: str, name: str = "rank") -> DataFrame:
    """`df` with `name`, the place of each row (from 1) in `order`, whose columns
    must tell rows apart. Each call writes the ranged rows to a new folder in `path`,
    so results of earlier calls stay readable."""
    path = f"{path.rstrip('/')}/{uuid.uuid4().hex[:12]}"
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    spark = df.sparkSession
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_range", T.IntegerType())])).parquet(path)
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return rows.withColumn("_row", local).join(offsets, "_range") \
        .select(*df.columns, (F.col("_before") + F.col("_row")).cast("bigint").alias(name))

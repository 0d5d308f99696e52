"""Shared helpers of the training-data operators.

`stage` cuts lineage with a written Parquet table in the shared folder of the
session; row ids that are drawn before a `stage` are fixed by it, so a lost
executor never changes them. Nothing here collects data to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.session import ensure_checkpoint_dir

# The white space of a word is x20 and x09 to x0D.
WORD = r"[^\x20\x09-\x0D]+"
NOT_WORD = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, data_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table of the data folder (the scan is pruned)."""
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


_recorders: list[list[str]] = []


@contextmanager
def recording(paths: list[str]) -> Iterator[None]:
    """Collect the paths of the tables that `stage` writes meanwhile."""
    _recorders.append(paths)
    try:
        yield
    finally:
        _recorders.remove(paths)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that no later read needs, and forget them."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(hadoop).delete(at, True)
    paths.clear()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet under the shared checkpoint folder and read it back.

    The table outlives any executor, later readers prune its columns, and joins
    on it get an exchange of their own, which adaptive execution may split
    where a key is hot."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex[:12]}-{name}"
    for paths in _recorders:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def or_empty(text: Column) -> Column:
    """Null text counts as empty."""
    return F.coalesce(text, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` words; null and empty texts have none.

    Counts the pieces between runs of white space, less the empty first and
    last piece."""
    t = or_empty(text)
    trimmed = F.regexp_replace(t, r"^[\x20\x09-\x0D]+", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, NOT_WORD)) - trimmed.rlike(r"[\x20\x09-\x0D]\z").cast("int")).cast("long")


def words(text: Column) -> Column:
    """Array of `[^\\x20\\x09-\\x0D]+` words; null has none."""
    return F.regexp_extract_all(or_empty(text), F.lit(f"({WORD})"), F.lit(1))


def quoted(name: str) -> Column:
    """A column by its exact name (dots and back-ticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: list[str] | tuple[str, ...]) -> list[Column]:
    """The columns of `df` whose names do not clash (in any case) with `names`."""
    taken = {n.lower() for n in names}
    return [quoted(c) for c in df.columns if c.lower() not in taken]


def running_sums(df: DataFrame, order: list[str], sums: list[str], name: str) -> DataFrame:
    """`df` with `rank` (from 1) and, for each column of `sums`, `before_<column>`:
    its exclusive running sum in the order of `order` (which must be unique).

    Two levels, so no task sees all rows: range partitions scan their own rows,
    and one row per partition carries the sums across."""
    from pyspark.sql import Window as W

    parts = stage(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), name)
    totals = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"),
                                         *[F.sum(c).alias(f"__t_{c}") for c in sums])
    prior = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("__part", F.coalesce(F.sum("__n").over(prior), F.lit(0)).alias("__rank0"),
                            *[F.coalesce(F.sum(f"__t_{c}").over(prior), F.lit(0)).alias(f"__b_{c}") for c in sums])
    within = W.partitionBy("__part").orderBy(*order)
    earlier = within.rowsBetween(W.unboundedPreceding, -1)
    local = parts.withColumn("__row", F.row_number().over(within))
    for c in sums:
        local = local.withColumn(f"__l_{c}", F.coalesce(F.sum(c).over(earlier), F.lit(0)))
    out = local.join(offsets, "__part")
    return out.select(*[quoted(c) for c in df.columns], (F.col("__rank0") + F.col("__row")).alias("rank"),
                      *[(F.col(f"__b_{c}") + F.col(f"__l_{c}")).alias(f"before_{c}") for c in sums])

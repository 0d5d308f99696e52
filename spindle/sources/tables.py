"""Parquet tables of a data directory. Reads are lazy: Catalyst prunes the
columns a query does not use and pushes filters into the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Setting: into how many partitions scans that ask for it are spread; unset, they
# keep the splits of the files.
SPREAD_SETTING = "spark.spindle.scanPartitions"

# Fixed values.
PARTS_PER_SPLIT = 8
MOST_PARTS = 10_000  # where splits are that many, `spark.sql.files.maxPartitionBytes` sizes them


def read_table(spark: SparkSession, data_dir: str, name: str, columns: list[str] | None = None,
               spread_key: str | None = None) -> DataFrame:
    """Scan a table. With `spread_key`, a scan ahead of CPU-heavy row work is
    spread into as many partitions as SPREAD_SETTING says (see `spread`)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    partitions = spark.conf.get(SPREAD_SETTING, None) if spread_key else None
    return spread(df, spread_key, int(partitions)) if partitions else df


def spread(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Hash-repartition on `xxhash64(key)` into `partitions`: for inputs with few
    splits (a file with one row group is one task). It is asked for explicitly -
    a large input has enough splits and should not pay for a shuffle.

    Hash (not round-robin) partitioning keeps task retries deterministic
    without a sort. Partitioning on an expression of the key rather than the
    key keeps the plan shape of a large input: an aggregate on (key, ...)
    downstream still has its own shuffle, which other branches of the same
    query can reuse (term frequencies feeding both IDF and the TF-IDF join)."""
    return df.repartition(partitions, F.xxhash64(key))


def smaller_parts(df: DataFrame, key: str) -> DataFrame:
    """`spread` over PARTS_PER_SPLIT times the splits, for texts whose words are
    grouped by row and word: such a grouping shrinks little, and what one split of a
    large table holds does not fit a task's memory and would be sorted on disk.
    Leaves a table that was spread on request as it is."""
    if df.sparkSession.conf.get(SPREAD_SETTING, None):
        return df
    splits = df.rdd.getNumPartitions()
    parts = min(PARTS_PER_SPLIT * splits, MOST_PARTS)
    return spread(df, key, parts) if parts > splits else df

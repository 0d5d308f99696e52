"""Commit records of micro-batches that write to several tables.

A micro-batch that writes two tables can stop between the writes. Each write alone
is idempotent (its partition is overwritten by the replay), but until the replay
the tables disagree. A batch is therefore visible only once its commit record
exists, which is made after the last write; readers of every table take committed
batches only. A record is an empty file, created in one step by the file system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Commits:
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _at(self, spark: SparkSession, name: str = ""):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path

    def publish(self, spark: SparkSession, batch_id: int) -> None:
        """Make batch `batch_id` visible (again, if it is replayed)."""
        fs, path = self._at(spark, f"batch_id={int(batch_id)}")
        fs.createNewFile(path)

    def numbers(self, spark: SparkSession) -> list[int]:
        fs, path = self._at(spark)
        if not fs.exists(path):
            return []
        return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path))

    def read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        """The committed batches of a table partitioned by batch_id (others are not
        listed by the scan)."""
        numbers = self.numbers(spark)
        if not numbers:
            return spark.createDataFrame([], f"{schema}, batch_id long")
        return spark.read.schema(f"{schema}, batch_id long").parquet(table).where(F.col("batch_id").isin(numbers))

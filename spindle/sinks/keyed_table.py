"""A keyed table fed by micro-batches: the newest value per key wins.

Newest means the largest of the `order` columns (event time, offset), in a stream
as in a batch: a record that arrives late but is older does not replace a newer
one. The batch id decides between rows that are equal in all of them.

Merge on read: each batch writes only its own newest row per key into the
partition `batch_id=N` (overwritten if the batch is replayed, so the sink is
idempotent under `foreachBatch`'s at-least-once delivery); a read resolves
the newest row per key with a partial aggregate. Writes cost O(batch), never a
rewrite of the table. `compact` publishes a snapshot of all batches up to one; a
snapshot counts once Spark has committed it, and reads then take the newest
snapshot and the later batches only. `vacuum` deletes what no read uses any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.operators.upsert import latest_per_key
from spindle.sinks.commits import Commits


class KeyedTable:
    def __init__(self, path: str, key: str, order: list[str], values: list[str], commits: Commits | None = None):
        """With `commits`, reads take only batches that have a commit record."""
        self.path, self.key, self.order, self.values = path.rstrip("/"), key, list(order), list(values)
        self.commits = commits

    def write_batch(self, batch: DataFrame, batch_id: int, extra_rejects: DataFrame | None = None) -> None:
        """Upsert one micro-batch. Rows with a null key, and `extra_rejects`
        (e.g. unparseable records), go to `rejects/batch_id=N` as strings."""
        bad = batch.filter(F.col(self.key).isNull())
        bad = bad.select([F.col(c).cast("string").alias(c) for c in bad.columns])
        if extra_rejects is not None:
            extra = extra_rejects.select([F.col(c).cast("string").alias(c) for c in extra_rejects.columns])
            bad = bad.unionByName(extra, allowMissingColumns=True)
        newest = latest_per_key(batch.filter(F.col(self.key).isNotNull()), self.key, self.order, self.values)
        (newest.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{self.path}/data"))
        (bad.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{self.path}/rejects"))

    def _files(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path

    def _numbers(self, spark: SparkSession, folder: str, prefix: str, committed: bool = False) -> list[int]:
        """The numbers of the sub-folders `prefix=N`, with `committed` only those that Spark finished."""
        fs, path = self._files(spark)
        if not fs.exists(path(f"{self.path}/{folder}")):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(f"{self.path}/{folder}"))]
        found = [int(n.split("=")[1]) for n in names if n.startswith(f"{prefix}=")]
        return sorted(n for n in found if not committed or fs.exists(path(f"{self.path}/{folder}/{prefix}={n}/_SUCCESS")))

    def _rows(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The newest snapshot and the batches after it (up to batch `upto`)."""
        snapshots = [n for n in self._numbers(spark, "snapshots", "upto", committed=True) if upto is None or n <= upto]
        after = snapshots[-1] if snapshots else None
        batches = [n for n in self._numbers(spark, "data", "batch_id") if (after is None or n > after) and (upto is None or n <= upto)]
        if self.commits is not None:
            visible = set(self.commits.numbers(spark))
            batches = [n for n in batches if n in visible]
        rows = [spark.read.parquet(f"{self.path}/snapshots/upto={after}")] if snapshots else []
        if batches or not snapshots:
            rows.append(spark.read.option("basePath", f"{self.path}/data")
                        .parquet(*[f"{self.path}/data/batch_id={n}" for n in batches]))
        return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.key, [*self.order, "batch_id"], self.values)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._newest(self._rows(spark)).drop("batch_id")

    def compact(self, spark: SparkSession, upto_batch: int) -> None:
        """Publish the state as of batch `upto_batch`. A batch up to it that is
        replayed later is already part of the snapshot."""
        folded = self._newest(self._rows(spark, upto_batch)).select(self.key, *self.order, *self.values, "batch_id")
        folded.write.mode("overwrite").parquet(f"{self.path}/snapshots/upto={int(upto_batch)}")

    def vacuum(self, spark: SparkSession) -> None:
        """Delete the batches and snapshots that the newest snapshot replaces.
        Readers that started before the snapshot should have ended."""
        snapshots = self._numbers(spark, "snapshots", "upto", committed=True)
        if not snapshots:
            return
        fs, path = self._files(spark)
        for n in snapshots[:-1]:
            fs.delete(path(f"{self.path}/snapshots/upto={n}"), True)
        for n in self._numbers(spark, "data", "batch_id"):
            if n <= snapshots[-1]:
                fs.delete(path(f"{self.path}/data/batch_id={n}"), True)

"""Running a stream over a table: the table is delivered in ordered batches of
files, a Structured Streaming query with the `availableNow` trigger takes one
batch per micro-batch, and its sink is a table with the micro-batch's number.

A delivery is what a source hands over between two triggers. Its files are written
by one job per batch (so they are ordered by time) and all batches have the same
number of files, which is also the most files of a trigger: micro-batch N is batch
N. `FILE_ROWS` sizes that number by the largest batch, so no task writes or reads a
whole batch of a large table; a batch with fewer rows gets empty files in addition.

The sink overwrites the partition of its micro-batch, so a micro-batch that is
replayed after a failure leaves no second copy. A stream is run in several starts
on one checkpoint, so every result also went through a restart.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.session import ensure_checkpoint_dir, stream_settings
from spindle.streaming.control import start

# Fixed values.
FILE_ROWS = 100_000
STARTS = 2  # starts of a stream on its checkpoint
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Delivery:
    """The rows of `df` as files, a batch for each value of column `batch` in
    ascending order (null first). The values are kept in `manifest`, one row each."""

    def __init__(self, df: DataFrame, batch: str, path: str):
        spark = df.sparkSession
        self.path, self.batch = path.rstrip("/"), batch
        counts = df.groupBy(batch).agg(F.count(F.lit(1)).alias("n")).orderBy(F.asc_nulls_first(batch)).collect()
        self.count = len(counts)
        kind = df.schema[batch].dataType.simpleString()
        self.manifest = spark.createDataFrame([(i, r[0]) for i, r in enumerate(counts)], f"batch_no long, `{batch}` {kind}")
        self.files = max(1, max((r["n"] for r in counts), default=0) // FILE_ROWS)
        self.schema = df.drop(batch).schema
        numbered = df.alias("d").join(F.broadcast(self.manifest.alias("m")), F.col(f"d.{batch}").eqNullSafe(F.col(f"m.{batch}")))
        numbered.select(*[f"d.{c}" for c in self.schema.names], "m.batch_no").write.partitionBy("batch_no").parquet(f"{self.path}/staged")

    @property
    def source(self) -> str:
        return f"{self.path}/source"

    def deliver(self, spark: SparkSession, first: int, until: int) -> None:
        """Write the files of batches first to until - 1 where the stream reads."""
        for number in range(first, until):
            rows = spark.read.schema(self.schema).parquet(f"{self.path}/staged/batch_no={number}")
            rows.repartition(self.files).write.mode("append").parquet(self.source)
            self._fill(spark, number)

    def _fill(self, spark: SparkSession, number: int) -> None:
        """Empty files where batch `number`, the last one written, has too few: a
        task without rows writes no file."""
        if self.files > 1:
            there = len(spark.read.schema(self.schema).parquet(self.source).inputFiles())
            for _ in range((number + 1) * self.files - there):
                spark.createDataFrame([], self.schema).coalesce(1).write.mode("append").parquet(self.source)

    def stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.schema(self.schema).option("maxFilesPerTrigger", self.files).parquet(self.source)


def stream_session(spark: SparkSession, settings: dict | None = None) -> SparkSession:
    """A session of the same application with a state store per core."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for k, v in {**stream_settings(spark.sparkContext.defaultParallelism), **(settings or {})}.items():
        session.conf.set(k, v)
    return session


def table_sink(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_no", F.lit(int(batch_id)).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_no").parquet(path))
    return write


class Run:
    """A stream over a delivery: `make` turns the delivered rows into the result,
    which `sink` (by default a table) takes. The folder of the run holds the
    files, the checkpoint and the sink's table."""

    def __init__(self, df: DataFrame, batch: str, make: Callable[[DataFrame], DataFrame], name: str, mode: str = "update",
                 sink: Callable[[DataFrame, int], None] | None = None, settings: dict | None = None, path: str | None = None):
        spark = df.sparkSession
        self.path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"
        self.spark, self.name, self.make, self.mode = spark, name, make, mode
        self.session = stream_session(spark, settings)
        self.delivery = Delivery(df, batch, self.path)
        self.sink = sink or table_sink(self.out)

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    @property
    def out(self) -> str:
        return f"{self.path}/out"

    def start(self) -> int:
        """Start the stream on its checkpoint and wait until it has taken all that
        is delivered. Returns the number of micro-batches it ran; raises what made
        it stop."""
        query = start(self.make(self.delivery.stream(self.session)), self.name, self.mode, trigger={"availableNow": True},
                      checkpoint_location=self.checkpoint, foreach_batch=self.sink)
        query.awaitTermination()
        return sum(p["numInputRows"] > 0 for p in query.recentProgress)

    def all(self, starts: int = STARTS) -> Run:
        """Deliver everything in `starts` parts, with a start of the stream after each."""
        n = self.delivery.count
        for i in range(starts):
            self.delivery.deliver(self.spark, n * i // starts, n * (i + 1) // starts)
            if n * (i + 1) // starts > n * i // starts:
                self.start()
        return self

    def result(self, schema: str, by_batch: bool = True) -> DataFrame:
        """The sink's rows (of the given schema), by default with the value of their
        batch. A stream with a watermark also runs micro-batches without rows, so
        its micro-batches are not the delivered batches: pass by_batch=False."""
        if not by_batch:
            empty = self.spark.createDataFrame([], schema)
            return self.spark.read.schema(empty.schema).parquet(self.out).select(empty.columns) if self.delivery.count else empty
        if not self.delivery.count:
            kind = self.delivery.manifest.schema[self.delivery.batch].dataType.simpleString()
            return self.spark.createDataFrame([], f"{schema}, `{self.delivery.batch}` {kind}")
        rows = self.spark.read.schema(f"{schema}, batch_no long").parquet(self.out)
        return rows.join(F.broadcast(self.delivery.manifest), "batch_no").drop("batch_no")

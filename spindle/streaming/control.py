"""Starting and stopping streaming queries."""

from __future__ import annotations

import atexit
import signal
import time

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from spindle.session import streaming_checkpoint


def start(df: DataFrame, name: str, output_mode: str = "update", sink: str = "memory",
          trigger: dict | None = None, checkpoint_location: str | None = None,
          foreach_batch=None, options: dict | None = None) -> StreamingQuery:
    """Start `df` as query `name`.

    `trigger`: e.g. {"processingTime": "10 seconds"} for a fixed micro-batch
    interval, {"availableNow": True} to drain what is there and stop.
    """
    spark = df.sparkSession
    writer = (df.writeStream.queryName(name).outputMode(output_mode)
              .option("checkpointLocation", checkpoint_location or streaming_checkpoint(spark, name)))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if foreach_batch is not None:
        writer = writer.foreachBatch(foreach_batch)
    else:
        writer = writer.format(sink)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def stop_gracefully(query: StreamingQuery, drain: bool = False, timeout: float = 300.0) -> None:
    """Let the running micro-batch end, then stop; after `timeout` seconds stop
    anyway (the batch is then replayed from the checkpoint on restart). With
    `drain`, first finish all data available now, which may never end on a live
    source."""
    if drain and query.isActive:
        query.processAllAvailable()
    end = time.monotonic() + timeout
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(0.05)
    query.stop()


def stop_on_exit(*queries: StreamingQuery, timeout: float = 300.0) -> None:
    """Shutdown hook: stop the queries gracefully on SIGTERM and at the end of the
    process. Call it from the main thread."""
    def stop_all() -> None:
        for query in queries:
            if query.isActive:
                stop_gracefully(query, timeout=timeout)

    def on_signal(number, frame) -> None:
        stop_all()

    signal.signal(signal.SIGTERM, on_signal)
    atexit.register(stop_all)

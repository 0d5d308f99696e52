"""Sessions closed by a marker row (the end-of-session rule, row level).

Per key, rows in event-time order; a marker row closes the session it ends
and the next reading starts a new one. The session number of a row is the
number of markers before it, a running count computed with the chunked scan
of `operators.running`, so a hot key is not one task. Totals per
(key, session) are a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.scalars import int_div
from spindle.operators.running import running_totals


def marker_sessions(readings: DataFrame, key: str = "session_id", order: list[str] | None = None,
                    chunk: Column | None = None) -> DataFrame:
    """`readings`: key, order columns, heart_rate, calorie, is_marker.
    Returns `(key, session_no, n, total_hr, total_cal, avg_hr, avg_cal, closed)`."""
    order = order or ["ts", "event_id"]
    r = readings.withColumn("m", F.col("is_marker").cast("bigint"))
    seen = running_totals(r, key, order, ["m"], prefix="cum_", chunk=chunk)
    seen = seen.withColumn("session_no", F.col("cum_m") - F.col("m"))
    reading = ~F.col("is_marker")
    agg = seen.groupBy(key, "session_no").agg(
        F.sum(F.when(reading, 1).otherwise(0)).cast("bigint").alias("n"),
        F.sum(F.when(reading, F.col("heart_rate")).otherwise(0)).cast("bigint").alias("total_hr"),
        F.sum(F.when(reading, F.col("calorie")).otherwise(0)).cast("bigint").alias("total_cal"),
        F.max("is_marker").alias("closed"))
    return agg.select(key, "session_no", "n", "total_hr", "total_cal",
                      int_div("total_hr", "n").alias("avg_hr"), int_div("total_cal", "n").alias("avg_cal"),
                      "closed")

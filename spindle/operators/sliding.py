"""Sliding-window counts (window `size`, advancing by `slide`).

Spark's `window(ts, size, slide)` copies every row into size/slide windows
(300 copies for 5 minutes / 1 second). Here rows are first pre-aggregated into
tumbling buckets of one slide (partial aggregation, one row per key and bucket).
A bucket then enters the running count at the first window that holds it and
leaves it after the last one, so each bucket makes two change rows whatever the
slide; the running sum of the changes of a key is the count of a window, and it
holds until the next change.

A key is not one task: its changes are cut into ranges of time of at least `size`,
so what a bucket holds crosses at most one end of a range. There the bucket makes a
third change row, which carries it into the next range. Ranges are then summed up,
and the windows between two changes filled in, each on its own.
Exact whenever `size` is a multiple of `slide`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindle.functions.scalars import bucket_start

# Fixed values.
RANGE_SECONDS = 3600  # of a key's changes in a task, at least the size of a window


def sliding_counts(df: DataFrame, ts: str, key: str | list[str], size_seconds: int, slide_seconds: int,
                   value: str | None = None, range_seconds: int = RANGE_SECONDS) -> DataFrame:
    """Rows (window_start, window_end, key..., n[, sum_value]) for every window
    that holds a row of the key. Rows without a time are in no window."""
    keys = [key] if isinstance(key, str) else list(key)
    if size_seconds % slide_seconds:
        raise ValueError("size must be a multiple of slide")
    aggs = [F.count(F.lit(1)).alias("_n")] + ([F.sum(value).alias("_v")] if value else [])
    sums = ["_n"] + (["_v"] if value else [])
    buckets = df.where(F.col(ts).isNotNull()).groupBy(*keys, bucket_start(ts, slide_seconds).alias("_bucket")).agg(*aggs)
    seconds = lambda n: F.make_dt_interval(secs=F.lit(n))
    length = -(-max(range_seconds, size_seconds) // slide_seconds) * slide_seconds
    # The first window with a bucket starts size - slide before it, the first one without it at its end.
    enter, leave = F.col("_bucket") - seconds(size_seconds - slide_seconds), F.col("_bucket") + seconds(slide_seconds)
    change = lambda at, sign: F.struct(at.alias("_at"), *[(F.lit(sign) * F.col(s)).alias(s) for s in sums])
    carried = F.when(bucket_start(enter, length) < bucket_start(leave, length), bucket_start(leave, length))
    changes = buckets.select(*keys, F.explode(F.array(change(enter, 1), change(leave, -1), change(carried, 1))).alias("c")) \
        .where("c._at IS NOT NULL")
    steps = changes.groupBy(*keys, F.col("c._at").alias("_at"), bucket_start("c._at", length).alias("_range")) \
        .agg(*[F.sum(f"c.{s}").alias(s) for s in sums])
    within = Window.partitionBy(*keys, "_range").orderBy("_at")
    state = steps.select(*keys, "_at", F.coalesce(F.lead("_at").over(within), F.col("_range") + seconds(length)).alias("_until"),
                           *[F.sum(x).over(within.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_run{x}") for x in sums])
    until = state.where("_run_n > 0")
    start = F.explode(F.sequence(F.col("_at"), F.col("_until") - seconds(slide_seconds), seconds(slide_seconds)))
    out = until.select(start.alias("window_start"), *keys, F.col("_run_n").alias("n"),
                       *([F.col("_run_v").alias(f"sum_{value}")] if value else []))
    return out.select("window_start", (F.col("window_start") + seconds(size_seconds)).alias("window_end"), *keys,
                      "n", *([f"sum_{value}"] if value else []))

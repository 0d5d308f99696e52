"""Sliding-window counts on a stream, event time with a watermark so old
windows are finalized and their state dropped.

`pre_aggregate=True` (append mode) chains two stateful aggregations: events
are first counted per key in tumbling buckets of one slide, and only those
bucket rows are spread over the windows containing them (`window_time` of the
bucket carries the event time forward). With a 5-minute window and 1-second
slide a plain `window()` keeps 300 copies of every event in state; this keeps
one row per key and second. Windows are emitted once the watermark passes
their end. `sliding_changes_stream` keeps each key's buckets once, by add and
subtract, in a state row per key and range of time. Watermarks need a zone-aware timestamp, so a zone-free event time
is cast with the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from spindle.streaming.groups import as_text

# Fixed values.
RANGE_SECONDS = 3600  # of a key's window starts in a state row, at least the size of a window


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def sliding_counts_stream(df: DataFrame, ts: str, key: str, size: str = "5 minutes",
                          slide: str = "1 second", watermark: str | None = "10 minutes",
                          pre_aggregate: bool = False) -> DataFrame:
    if pre_aggregate:
        if not watermark:
            raise ValueError("pre_aggregate needs a watermark (append mode)")
        df = _event_time(df, ts).withWatermark(ts, watermark)
        buckets = df.groupBy(F.window(ts, slide).alias("_b"), key).agg(F.count(F.lit(1)).alias("_n"))
        out = buckets.groupBy(F.window(F.window_time("_b"), size, slide).alias("w"), key) \
            .agg(F.sum("_n").alias("n"))
    else:
        if watermark:
            df = _event_time(df, ts).withWatermark(ts, watermark)
        out = df.groupBy(F.window(ts, size, slide).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n")


class _Slides(StatefulProcessor):
    """Add and subtract for the windows of a key that start in one range of time. The
    state holds the range's buckets (position and count), the next window to emit, the
    count of the one before it and the key's timer (0: none). All in slides."""

    def __init__(self, key: str, per_window: int, slide: int, length: int):
        self.key, self.per_window, self.slide, self.length = key, per_window, slide, length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buckets = handle.getValueState("buckets", "at array<long>, n array<long>, next long, before long, wake long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat([pdf[["bucket", "n"]] for pdf in rows])
        yield from self._advance(key, fresh["bucket"].to_numpy(np.int64), fresh["n"].to_numpy(np.int64), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        none = np.array([], dtype=np.int64)
        yield from self._advance(key, none, none, timerValues)

    def _advance(self, key, fresh: np.ndarray, counts: np.ndarray, timers) -> Iterator[pd.DataFrame]:
        """Emit the range's windows that end by the watermark."""
        held = self.buckets.get()
        at, n, first, before, wake = held or ([], [], None, 0, 0)
        at, n = np.append(np.array(at, dtype=np.int64), fresh), np.append(np.array(n, dtype=np.int64), counts)
        order = np.argsort(at, kind="stable")
        at, n = at[order], n[order]
        if not len(at):
            return
        lo = int(key[1]) * self.length
        end = lo + self.length
        first = max(lo, int(at[0]) - self.per_window + 1) if first is None else first
        now = timers.getCurrentWatermarkInMs()
        last = min(now // (1000 * self.slide) - self.per_window, end - 1)  # start of the last final window
        if last >= first:
            # A bucket enters the window that it ends (or the range's first one) and leaves after the one that it starts.
            moves = np.concatenate([np.maximum(at - self.per_window + 1, lo), at + 1])
            change = np.concatenate([n, -n])
            due = (moves >= first) & (moves <= last)
            order = np.argsort(moves[due], kind="stable")
            moves, change = moves[due][order], change[due][order]
            count = before + np.cumsum(change)
            until = np.append(moves[1:], last + 1)
            if before and (not len(moves) or moves[0] > first):
                moves, count, until = np.insert(moves, 0, first), np.insert(count, 0, before), np.insert(until, 0, moves[0] if len(moves) else last + 1)
            before = int(count[-1]) if len(count) else before
            first = last + 1
            n, at = n[at >= last], at[at >= last]
            kept = (count > 0) & (until > moves)
            if kept.any():
                yield pd.DataFrame({"start": moves[kept], "until": until[kept], self.key: pd.Series([key[0]] * int(kept.sum()), dtype="object"),
                                    "n": count[kept]})
        due = (max(first, int(at[0]) - self.per_window + 1) + self.per_window) * self.slide * 1000 if len(at) and first < end else 0
        if wake != due:
            if wake > now:  # otherwise it has fired
                self.handle.deleteTimer(wake)
            if due:
                self.handle.registerTimer(due)
        if due:
            self.buckets.update((at.tolist(), n.tolist(), first, before, due))
        elif held:
            self.buckets.clear()

    def close(self) -> None:
        pass


def sliding_changes_stream(df: DataFrame, ts: str, key: str, size_seconds: int, slide_seconds: int,
                           watermark: str = "10 minutes") -> DataFrame:
    """(window_start, window_end, key, n) of every window that holds a row of the
    key, emitted when the watermark passes its end.

    Rows are counted in buckets of one slide by a streaming aggregate (with a
    partial sum before the shuffle, so a hot key comes as a row per slide). The
    windows are then kept by add and subtract in `transformWithStateInPandas`, in a
    state row for each key and range of RANGE_SECONDS of window starts, so that a key
    is not one task: a range holds the buckets that its windows hold, whatever the
    slide (those within a window's size of a cut are in two ranges), and each step
    costs the buckets that enter and leave. What comes out of Python is a row per
    stretch of windows of equal count; the windows are filled in above it. A timer
    wakes a range without new rows at its next window's end. Needs the RocksDB state
    store. Rows without a time are in no window; null keys are a key."""
    if size_seconds % slide_seconds:
        raise ValueError("size must be a multiple of slide")
    kind = df.schema[key].dataType.simpleString()
    zone_free = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    per_window, length = size_seconds // slide_seconds, -(-max(RANGE_SECONDS, size_seconds) // slide_seconds)
    events = _event_time(df.select(ts, key), ts).withWatermark(ts, watermark)
    buckets = events.groupBy(F.window(ts, f"{slide_seconds} seconds").alias("b"), key).agg(F.count(F.lit(1)).alias("n"))
    narrow = buckets.select(F.window_time("b").alias("t"), as_text(key).alias(key), F.floor(F.unix_seconds("b.start") / slide_seconds).alias("bucket"), "n")
    ranges = F.sequence(F.floor((F.col("bucket") - (per_window - 1)) / length), F.floor(F.col("bucket") / length))
    placed = narrow.select("*", F.explode(ranges).alias("_range"))
    runs = placed.groupBy(key, "_range").transformWithStateInPandas(
        _Slides(key, per_window, slide_seconds, length), f"start long, until long, `{key}` string, n long", "Append", "eventTime")
    out = runs.select(F.explode(F.sequence("start", F.col("until") - 1)).alias("start"), F.col(key).cast(kind).alias(key), "n")
    when = lambda c: F.timestamp_seconds(c * slide_seconds).cast("timestamp_ntz" if zone_free else "timestamp")
    windows = F.col("start"), F.col("start") + per_window
    return out.select(*[when(c).alias(x) for c, x in zip(windows, ("window_start", "window_end"))], key, "n")

"""Sessions on a stream in event time: a marker row or a silence closes a session.

Rows wait in the state until the watermark passes them and are then taken in
event-time order, so late rows within the watermark's delay and the cut in
micro-batches change nothing. A marker closes the session it belongs to. A session
without rows for `idle` is closed by an event-time timer, also when no other row of
its key ever comes; a row after a longer silence opens the next session. Each
session is emitted once, when it is closed, and its state is dropped.

Keys share state by groups (`spindle.streaming.groups`), so a micro-batch costs a
call and a timer per group and not per key. State of a group: the waiting rows (those
within the watermark's delay) in chunks of CHUNK_ROWS, and the number and totals of
each key's open session, side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from spindle.streaming.groups import as_text, plain, state_group

# Fixed values.
CHUNK_ROWS = 10_000  # waiting rows in an element of the state's list

_ROWS = "who array<string>, at array<long>, tie array<long>, heart_rate array<long>, calorie array<long>, marker array<boolean>"
_OPEN = ("who array<string>, number array<long>, first array<long>, last array<long>, n array<long>, heart_rate array<long>, "
         "calorie array<long>, wake long, waiting long")
_OUT = ("session_no bigint, first_us bigint, last_us bigint, n bigint, total_hr bigint, total_cal bigint, closed_by string")
_IN_ORDER = itemgetter(1, 2, 3, 4, 5)  # of (who, at, tie, heart_rate, calorie, marker)


class _Sessions(StatefulProcessor):
    """Times in microseconds."""

    def __init__(self, key: str, idle: int):
        self.key, self.idle = key, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _ROWS)
        self.open = handle.getValueState("open", _OPEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = [row for pdf in rows
                 for row in zip(plain(pdf["who"]), *[pdf[c].tolist() for c in ("at", "tie", "heart_rate", "calorie", "is_marker")])]
        yield from self._advance(fresh, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance([], timerValues)

    def _advance(self, fresh: list[tuple], timers) -> Iterator[pd.DataFrame]:
        now = timers.getCurrentWatermarkInMs() * 1000
        # `wake` is the group's timer (0: none) and `rows` the number of waiting rows.
        *held, wake, rows = self.open.get() or ([], [], [], [], [], [], [], 0, 0)
        sessions = {who: s for who, *s in zip(*held)}  # [number, first, last, n, hr, cal] of each key
        held = [row for chunk in self.waiting.get() for row in zip(*chunk)] if rows else []
        held = [*held, *fresh]
        ready = sorted((r for r in held if r[1] <= now), key=_IN_ORDER)
        later = [r for r in held if r[1] > now]
        closed: list[tuple] = []

        def close(who, s: list, by: str) -> None:
            closed.append((who, *s, by))
            s[:] = s[0] + 1, -1, s[2], 0, 0, 0

        for who, at, _, hr, cal, marker in ready:
            s = sessions.setdefault(who, [0, -1, -1, 0, 0, 0])
            if s[1] >= 0 and at - s[2] > self.idle:
                close(who, s, "idle")
            if s[1] < 0:
                s[1] = at
            s[2] = at
            if marker:
                close(who, s, "marker")
            else:
                s[3], s[4], s[5] = s[3] + 1, s[4] + hr, s[5] + cal
        for who, s in sessions.items():
            if s[1] >= 0 and s[2] + self.idle < now:
                close(who, s, "idle")
        if later:
            if ready:
                self.waiting.put(_chunks(later))
            elif fresh:
                self.waiting.appendList(_chunks(fresh))
        elif rows:
            self.waiting.clear()
        due = [s[2] + self.idle for s in sessions.values() if s[1] >= 0] + [r[1] for r in later]
        due = min(due) // 1000 + 1 if due else 0
        if due != wake:
            if wake * 1000 > now:  # otherwise it has fired
                self.handle.deleteTimer(wake)
            if due:
                self.handle.registerTimer(due)
        columns = [list(sessions), *[[s[i] for s in sessions.values()] for i in range(6)]]
        self.open.update((*columns, due, len(later)))
        if closed:
            columns = ["who", "session_no", "first_us", "last_us", "n", "total_hr", "total_cal", "closed_by"]
            yield pd.DataFrame(closed, columns=columns)

    def close(self) -> None:
        pass


def _chunks(rows: list[tuple]) -> list[tuple]:
    return [tuple(map(list, zip(*rows[i:i + CHUNK_ROWS]))) for i in range(0, len(rows), CHUNK_ROWS)]


def closed_sessions_stream(readings: DataFrame, idle_seconds: int, key: str = "session_id", ts: str = "ts",
                           tie: str = "event_id", watermark: str = "10 minutes") -> DataFrame:
    """(key, session_no, first_ts, last_ts, n, total_hr, total_cal, closed_by) of each
    session as it closes: by its `marker` row, or `idle` when nothing came for
    `idle_seconds`. `readings` has heart_rate, calorie and is_marker; a marker adds
    its time but no reading. Rows of equal time go by `tie`. Rows without a time
    have no place and are left out; null readings add 0. Needs the RocksDB store."""
    zone_free = isinstance(readings.schema[ts].dataType, T.TimestampNTZType)
    kind = readings.schema[key].dataType.simpleString()
    rows = readings.where(F.col(ts).isNotNull()).withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    whole = lambda c, other: F.coalesce(F.col(c).cast("long"), F.lit(other).cast("long"))
    rows = rows.select(state_group(key).alias("_group"), as_text(key).alias("who"), ts, F.unix_micros(ts).alias("at"), whole(tie, 2**63 - 1).alias("tie"),
                       whole("heart_rate", 0).alias("heart_rate"), whole("calorie", 0).alias("calorie"), F.coalesce("is_marker", F.lit(False)).alias("is_marker"))
    out = rows.groupBy("_group").transformWithStateInPandas(_Sessions(key, idle_seconds * 1_000_000), f"who string, {_OUT}", "Append", "eventTime")
    when = lambda c: F.timestamp_micros(c).cast("timestamp_ntz" if zone_free else "timestamp")
    return out.select(F.col("who").cast(kind).alias(key), "session_no", when(F.col("first_us")).alias("first_ts"), when(F.col("last_us")).alias("last_ts"),
                      "n", "total_hr", "total_cal", "closed_by")

"""Running sensor totals per session with the batch-sum reset rule, as a
stateful stream (`applyInPandasWithState`).

Per micro-batch and session: add up *all* the rows the batch holds for the
session (they may arrive in several Arrow chunks); if both sums are -1 the
state resets to (0, 0, 1) - or (0, 0) without the count - else the sums are
added. The output is the new state and the truncated averages. In `remove`
mode a reset clears the state instead (the end-of-session rule).

Rows are summed per session and Arrow batch where they are read, and reach the
state step by group of sessions (`spindle.streaming.groups`): a state row holds the
totals of its group's sessions side by side, so a micro-batch costs a call per
group and not per session. Only the form with an idle timeout keeps a state row
per session, since a timeout belongs to a row. The state lives in the state store
under the query checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spindle.streaming.groups import as_text, plain, state_group


# The state of a group: its sessions and their totals, side by side.
GROUP_STATE = "who array<string>, hr array<bigint>, cal array<bigint>, n array<bigint>"


def _tdiv(a: int, b: int):
    """Integer division truncating toward zero (exact for any int size)."""
    if not b:
        return None
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def _step(totals: tuple, sums: tuple, track_count: bool) -> tuple[tuple, bool]:
    """A session's totals (heart rate, calorie, count) after a batch with these sums,
    and whether the batch reset them."""
    if sums[0] == -1 and sums[1] == -1:
        return (0, 0, 1 if track_count else 0), True
    return tuple(a + b for a, b in zip(totals, sums)), False


def _state_fn(track_count: bool, on_reset: str, idle_timeout_ms: int | None = None):
    def update(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if idle_timeout_ms is not None and state.hasTimedOut:
            state.remove()  # session idle too long: its state is dropped, nothing is emitted
            return
        hr = cal = n = 0
        for pdf in chunks:
            hr += int(pdf["heart_rate"].sum())
            cal += int(pdf["calorie"].sum())
            n += int(pdf["n"].sum()) if "n" in pdf else len(pdf)
        (th, tc, tn), reset = _step(state.get if state.exists else (0, 0, 0), (hr, cal, n), track_count)
        if reset and on_reset == "remove":
            state.remove()
        else:
            state.update((th, tc, tn))
        if idle_timeout_ms is not None and state.exists:
            state.setTimeoutDuration(idle_timeout_ms)
        row = {"session_id": [key[0]], "total_hr": [th], "total_cal": [tc]}
        if track_count:
            row["total_n"] = [tn]
            row["avg_hr"] = [_tdiv(th, tn)]
            row["avg_cal"] = [_tdiv(tc, tn)]
        yield pd.DataFrame(row)
    return update


def _group_fn(key: str, track_count: bool, on_reset: str):
    """`_state_fn` for all sessions of a group in one call."""
    def update(group, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for pdf in chunks:
            for who, hr, cal, n in zip(plain(pdf[key]), pdf["heart_rate"].tolist(), pdf["calorie"].tolist(), pdf["n"].tolist()):
                h, c, m = sums.get(who, (0, 0, 0))
                sums[who] = (h + hr, c + cal, m + n)
        held = state.get if state.exists else ([], [], [], [])
        totals = {who: t for who, *t in zip(*held)}
        out = []
        for who, s in sums.items():
            t, reset = _step(totals.get(who, (0, 0, 0)), s, track_count)
            if reset and on_reset == "remove":
                totals.pop(who, None)
            else:
                totals[who] = t
            out.append((who, *t))
        if totals:
            state.update((list(totals), *[[t[i] for t in totals.values()] for i in range(3)]))
        elif state.exists:
            state.remove()
        rows = pd.DataFrame({"session_id": pd.Series([r[0] for r in out], dtype="object"),
                             "total_hr": [r[1] for r in out], "total_cal": [r[2] for r in out]})
        if track_count:
            rows["total_n"] = [r[3] for r in out]
            rows["avg_hr"] = pd.Series([_tdiv(r[1], r[3]) for r in out], dtype="object")
            rows["avg_cal"] = pd.Series([_tdiv(r[2], r[3]) for r in out], dtype="object")
        yield rows
    return update


def _partial_sums(key: str):
    """Sums per key of one Arrow batch: what a keyed state step gets is at most one
    row per key and batch, so a hot session is summed where its rows are read."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nulls = pc.ScalarAggregateOptions(skip_nulls=True, min_count=0)
        sums_of = [("heart_rate", "sum", nulls), ("calorie", "sum", nulls), ("heart_rate", "count", pc.CountOptions(mode="all"))]
        names = [key, "heart_rate_sum", "calorie_sum", "heart_rate_count"]
        for batch in batches:
            if batch.num_rows:
                grouped = pa.Table.from_batches([batch]).group_by(key, use_threads=False).aggregate(sums_of).select(names)
                yield from grouped.rename_columns([key, "heart_rate", "calorie", "n"]).combine_chunks().to_batches()
    return sums


def sensor_state_stream(readings: DataFrame, track_count: bool = True, on_reset: str = "keep",
                        key: str = "session_id", idle_timeout_ms: int | None = None) -> DataFrame:
    """`readings`: streaming rows (session_id, heart_rate, calorie).

    `idle_timeout_ms`: drop a session's state after that long (processing
    time) without readings; without it state lives for ever, as in the
    original jobs."""
    key_type = readings.schema[key].dataType.simpleString()
    out = f"session_id {key_type}, total_hr bigint, total_cal bigint"
    if track_count:
        out += ", total_n bigint, avg_hr bigint, avg_cal bigint"
    state = "hr bigint, cal bigint, n bigint"
    sums = readings.select(key, *[F.col(c).cast("bigint").alias(c) for c in ("heart_rate", "calorie")]).mapInArrow(
        _partial_sums(key), f"{key} {key_type}, heart_rate bigint, calorie bigint, n bigint")
    if idle_timeout_ms is not None:
        return sums.groupBy(key).applyInPandasWithState(
            _state_fn(track_count, on_reset, idle_timeout_ms), out, state, "update", GroupStateTimeout.ProcessingTimeTimeout)
    grouped = sums.select(state_group(key).alias("_group"), as_text(key).alias(key), "heart_rate", "calorie", "n").groupBy("_group")
    rows = grouped.applyInPandasWithState(
        _group_fn(key, track_count, on_reset), out.replace(f"session_id {key_type}", "session_id string", 1), GROUP_STATE, "update",
        GroupStateTimeout.NoTimeout)
    return rows.withColumn("session_id", F.col("session_id").cast(key_type))


def sensor_states(rows: DataFrame, key_type: str) -> DataFrame:
    """(session_id, total_hr, total_cal, total_n) from the rows of the state store
    (`statestore` source) of a `sensor_state_stream` without idle timeout."""
    held = F.col("value.groupState")
    one = rows.select(F.explode(F.arrays_zip(*[held[c].alias(c) for c in ("who", "hr", "cal", "n")])).alias("s"))
    return one.select(F.col("s.who").cast(key_type).alias("session_id"), F.col("s.hr").alias("total_hr"),
                      F.col("s.cal").alias("total_cal"), F.col("s.n").alias("total_n"))


def _marker_fn(order: list[str]):
    def update(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(chunks), ignore_index=True)
        if pdf.empty:
            return
        pdf = pdf.sort_values(order, kind="mergesort")
        sno, th, tc, tn = state.get if state.exists else (0, 0, 0, 0)
        marker = pdf["is_marker"].astype(bool).to_numpy()
        m = marker.astype("int64")
        pdf["session_no"] = sno + (m.cumsum() - m)          # markers strictly before the row
        reading = ~marker
        pdf["_r"] = reading.astype("int64")
        pdf["_h"] = pdf["heart_rate"].where(reading, 0).astype("int64")
        pdf["_c"] = pdf["calorie"].where(reading, 0).astype("int64")
        g = pdf.groupby("session_no").agg(n=("_r", "sum"), hr=("_h", "sum"), cal=("_c", "sum"),
                                          closed=("is_marker", "any"))
        if sno in g.index:                                  # the open session continues
            g.loc[sno, "n"] += tn
            g.loc[sno, "hr"] += th
            g.loc[sno, "cal"] += tc
        last = sno + int(m.sum())
        if last in g.index and not bool(g.loc[last, "closed"]):
            state.update((last, int(g.loc[last, "hr"]), int(g.loc[last, "cal"]), int(g.loc[last, "n"])))
        else:                                               # ended on a marker: a new, empty session
            state.update((last, 0, 0, 0))
        yield pd.DataFrame({
            "session_id": [key[0]] * len(g),
            "session_no": g.index.astype("int64"),
            "n": g["n"].astype("int64"), "total_hr": g["hr"].astype("int64"),
            "total_cal": g["cal"].astype("int64"),
            "avg_hr": [_tdiv(int(h), int(n)) for h, n in zip(g["hr"], g["n"])],
            "avg_cal": [_tdiv(int(c), int(n)) for c, n in zip(g["cal"], g["n"])],
            "closed": g["closed"].astype(bool),
        })
    return update


def marker_session_stream(readings: DataFrame, key: str = "session_id",
                          order: list[str] | None = None) -> DataFrame:
    """Row-level end-of-session rule on a stream: within each micro-batch a
    session's rows are taken in event-time order, every marker row closes the
    current session, and the totals of each session the batch touched are
    emitted (the last emission of a session is its final total). Unlike the
    batch-sum form this sorts a key's rows of one micro-batch, so that much
    is held in memory per key; micro-batch size bounds it."""
    order = order or ["ts", "event_id"]
    key_type = readings.schema[key].dataType.simpleString()
    out = (f"session_id {key_type}, session_no bigint, n bigint, total_hr bigint, total_cal bigint, "
           "avg_hr bigint, avg_cal bigint, closed boolean")
    state = "session_no bigint, hr bigint, cal bigint, n bigint"
    return (readings.select(key, *order, "heart_rate", "calorie", "is_marker")
            .groupBy(key)
            .applyInPandasWithState(_marker_fn(order), out, state, "update", GroupStateTimeout.NoTimeout))

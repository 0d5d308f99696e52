"""Registered stream runs: name -> f(spark, data_dir) -> DataFrame.

Each delivers a given table in ordered batches to a Structured Streaming query,
runs it in several starts on one checkpoint and returns what its sink or its state
holds (see `spindle.streaming.replay`). The batches are hours of the day, two at a
time, stretches of time whose length follows the table's, or a hash of the
conversation, so their number does not grow with the table and a batch does. Runs that several queries read are made once per application and data folder.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.functions.scalars import bucket_start, int_div
from spindle.functions.text import lines_of
from spindle.operators.upsert import to_cells
from spindle.plans import derived
from spindle.sinks.commits import Commits
from spindle.sinks.keyed_table import KeyedTable
from spindle.sources.tables import read_table
from spindle.streaming.keyed import AUDIT_SCHEMA, tweets_from_records, upsert_batch_fn
from spindle.streaming.replay import ROCKSDB, Run
from spindle.streaming.sensor import sensor_state_stream, sensor_states
from spindle.streaming.sessions import closed_sessions_stream
from spindle.streaming.sliding import sliding_changes_stream
from spindle.streaming.wordcount import running_word_counts

# Fixed values.
WORD_BATCHES = 12
HOURS = 2      # of the day in a batch
SLIDING_BATCH, SLIDING_BATCHES = 5 * derived.DAY, 8  # least length, most batches
SESSION_BATCH, SESSION_BATCHES = 15 * derived.DAY, 4
WATERMARK = "10 minutes"
IDLE = 6 * derived.HOUR
STOP_AT = 5  # the micro-batch in which the upsert run stops between its writes
TOTALS = "session_id bigint, total_hr bigint, total_cal bigint"
AVERAGES = f"{TOTALS}, total_n bigint, avg_hr bigint, avg_cal bigint"

_RUNS: dict = {}


def _hours(ts: str) -> Column:
    return F.floor(F.hour(ts) / HOURS).cast("int")


def _stretches(df: DataFrame, ts: str, least: int, most: int) -> Column:
    """Start of the batch of a row: stretches of time of the same length, `least`
    seconds or a multiple of it that cuts the table in no more than about `most`."""
    first, last = df.agg(F.min(ts), F.max(ts)).first()
    seconds = (last - first).total_seconds() if first else 0
    return bucket_start(ts, least * max(1, math.ceil(seconds / (least * most))))


def _once(spark: SparkSession, d: str, kind: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, d, kind)
    if key not in _RUNS:
        _RUNS[key] = make()
    return _RUNS[key]


def _sensor_run(spark: SparkSession, d: str, track_count: bool) -> Run:
    readings = derived.sensor_readings(spark, d).select("session_id", "heart_rate", "calorie", _hours("ts").alias("batch"))
    return _once(spark, d, f"sensor-{track_count}", lambda: Run(
        readings, "batch", lambda rows: sensor_state_stream(rows, track_count=track_count), f"sensor_{track_count}".lower()).all())


def stream_sensor_avg(spark: SparkSession, d: str) -> DataFrame:
    """Running totals and averages per session after each micro-batch, as emitted."""
    return _sensor_run(spark, d, True).result(AVERAGES)


def stream_sensor_totals(spark: SparkSession, d: str) -> DataFrame:
    """The same without the count: a reset sets both totals to 0."""
    return _sensor_run(spark, d, False).result(TOTALS)


def stream_sensor_state(spark: SparkSession, d: str) -> DataFrame:
    """Every session's state after the last micro-batch, read back from the state
    store of the checkpoint (not from the sink)."""
    run = _sensor_run(spark, d, True)
    if not run.delivery.count:
        return spark.createDataFrame([], AVERAGES)
    rows = run.session.read.format("statestore").load(run.checkpoint)
    state = sensor_states(rows, "bigint")
    return state.select("*", int_div("total_hr", "total_n").alias("avg_hr"), int_div("total_cal", "total_n").alias("avg_cal"))


def stream_word_count(spark: SparkSession, d: str) -> DataFrame:
    """Running count of every word of the lines of the conversations, after each
    micro-batch that holds the word."""
    texts = read_table(spark, d, "conversations").select("text", F.pmod("conv_id", F.lit(WORD_BATCHES)).alias("batch"))
    run = _once(spark, d, "words", lambda: Run(
        texts, "batch", lambda rows: running_word_counts(rows.select(F.explode(lines_of("text")).alias("line")), "line"), "words").all())
    return run.result("word string, n bigint")


def stream_sliding_count(spark: SparkSession, d: str) -> DataFrame:
    """Five-minute windows at a slide of one second, by add and subtract: all windows
    that end by the last watermark."""
    events = read_table(spark, d, "events").select("ts", "event_type").where("ts IS NOT NULL")
    run = _once(spark, d, "sliding", lambda: Run(
        events.withColumn("batch", _stretches(events, "ts", SLIDING_BATCH, SLIDING_BATCHES)), "batch", lambda rows: sliding_changes_stream(rows, "ts", "event_type", 300, 1, WATERMARK),
        "sliding", "append", settings={"spark.sql.streaming.stateStore.providerClass": ROCKSDB}).all())
    return run.result("window_start timestamp_ntz, window_end timestamp_ntz, event_type string, n bigint", by_batch=False)


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions in event time, closed by a marker or by IDLE seconds of silence."""
    readings = derived.sensor_readings(spark, d).select(
        "session_id", "ts", "event_id", "heart_rate", "calorie", "is_marker").where("ts IS NOT NULL")
    run = _once(spark, d, "sessions", lambda: Run(
        readings.withColumn("day", _stretches(readings, "ts", SESSION_BATCH, SESSION_BATCHES)), "day", lambda rows: closed_sessions_stream(rows, IDLE, watermark=WATERMARK), "sessions", "append",
        settings={"spark.sql.streaming.stateStore.providerClass": ROCKSDB}).all())
    return run.result("session_id bigint, session_no bigint, first_ts timestamp_ntz, last_ts timestamp_ntz, n bigint, total_hr bigint, "
                      "total_cal bigint, closed_by string", by_batch=False)


class _StoppedBetweenWrites(Exception):
    pass


def _upsert_run(spark: SparkSession, d: str) -> tuple[Run, KeyedTable, str]:
    """Upserts and offset audit of Kafka records. The first start stops between the
    two writes of micro-batch STOP_AT; the second one replays that batch."""
    def make():
        records = derived.kafka_records(spark, d).withColumn("batch", _hours("timestamp"))
        run = Run(records, "batch", tweets_from_records, "upserts", "append")
        table = KeyedTable(f"{run.path}/table", "id_str", ["timestamp", "offset"], ["created_at"], Commits(f"{run.path}/commits"))
        audit = f"{run.path}/audit"

        def stop(batch_id: int) -> None:
            if batch_id == STOP_AT:
                raise _StoppedBetweenWrites

        run.delivery.deliver(spark, 0, run.delivery.count)
        if run.delivery.count:
            run.sink = upsert_batch_fn(table, audit, between=stop)
            try:
                run.start()
            except StreamingQueryException as stopped:
                if _StoppedBetweenWrites.__name__ not in str(stopped):
                    raise
            run.sink = upsert_batch_fn(table, audit)
            run.start()
        return run, table, audit

    return _once(spark, d, "upserts", make)


def stream_tweet_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The cells of the keyed table after the run: the newest value of each tweet id."""
    run, table, _ = _upsert_run(spark, d)
    if not run.delivery.count:
        return spark.createDataFrame([], "row_key string, family string, qualifier string, value string")
    return to_cells(table.read(spark), "id_str", "twt", {"createdat": "created_at"})


def stream_offset_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The committed offset ranges of each micro-batch."""
    run, table, audit = _upsert_run(spark, d)
    rows = table.commits.read(spark, audit, AUDIT_SCHEMA)
    return rows.join(F.broadcast(run.delivery.manifest), rows["batch_id"] == F.col("batch_no")).drop("batch_no", "batch_id")


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_sensor_avg": stream_sensor_avg,
    "stream_sensor_totals": stream_sensor_totals,
    "stream_sensor_state": stream_sensor_state,
    "stream_word_count": stream_word_count,
    "stream_sliding_count": stream_sliding_count,
    "stream_sessions": stream_sessions,
    "stream_tweet_upsert": stream_tweet_upsert,
    "stream_offset_ranges": stream_offset_ranges,
}

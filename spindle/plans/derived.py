"""Stand-in inputs derived from the given tables, so each job's work grows
with the data.

* labelled sentences: documents joined to labels, label = quality (0/1);
* text lines in the original CSV / TSV layouts, rendered from those rows
  (line breaks of a text become spaces so one record stays one line);
* sensor readings: events, session = user_id, heart rate = int(value),
  calorie = props.k, an `error` event is the (-1, -1) marker, batch = hour;
* Kafka records: events as rows of the Kafka source schema; value is a JSON
  tweet-like document, partition = user_id mod 4, offset = event_id;
* users and roles: customers (username = c_name) and their orders
  (role = o_orderpriority).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.functions.scalars import binarize_label, bucket_start
from spindle.functions.text import java_split, lines_of
from spindle.sources.kafka import as_kafka_records
from spindle.sources.tables import read_table

# Stand-in settings.
KAFKA_TOPIC = "events"
KAFKA_PARTITIONS = 4
HOUR = 3600
DAY = 86400
SENSOR_BATCH = HOUR   # one micro-batch per hour of events
SENSOR_CHUNK = DAY    # scan chunk of (session, hour) rows: at most 24 rows
ROW_CHUNK = 60        # scan chunk of raw readings (row-level rules): one minute
WORD_BATCH = DAY
WORD_CHUNK = 7 * DAY
TURN_CHUNK = 16        # scan chunk of (word, turn) rows
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def labelled_docs(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text"], spread_key="doc_id")
    labels = read_table(spark, d, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        "doc_id", binarize_label("quality").alias("label"), F.col("text").alias("sentence"))


def _one_line(c):
    return F.regexp_replace(c, "\\r\\n|\\r|\\n", " ")


def csv_lines_layout_a(spark: SparkSession, d: str) -> DataFrame:
    """`"label","id","lang","source","u","text"` with label 0 or 4; quotes in
    the text are doubled, so a quote-aware reader recovers it."""
    docs = read_table(spark, d, "documents", ["doc_id", "text", "lang", "source"], spread_key="doc_id")
    labels = read_table(spark, d, "labels").select("doc_id", "quality")
    text = F.replace(_one_line(F.col("text")), F.lit('"'), F.lit('""'))
    line = F.concat(F.lit('"'), (F.col("quality") * 4).cast("string"), F.lit('","'),
                    F.col("doc_id").cast("string"), F.lit('","'), F.col("lang"), F.lit('","'),
                    F.col("source"), F.lit('","u","'), text, F.lit('"'))
    return docs.join(labels, "doc_id").select("doc_id", line.alias("value"))


def csv_lines_layout_b(spark: SparkSession, d: str) -> DataFrame:
    """`id,label,source,text`, unquoted."""
    docs = read_table(spark, d, "documents", ["doc_id", "text", "source"], spread_key="doc_id")
    labels = read_table(spark, d, "labels").select("doc_id", "quality")
    line = F.concat_ws(",", F.col("doc_id").cast("string"), F.col("quality").cast("string"),
                       F.col("source"), _one_line(F.col("text")))
    return docs.join(labels, "doc_id").select("doc_id", line.alias("value"))


def tsv_lines_text_first(spark: SparkSession, d: str) -> DataFrame:
    """`text[\\tlabel]`: documents without a label have no label field."""
    docs = read_table(spark, d, "documents", ["doc_id", "text"], spread_key="doc_id")
    labels = read_table(spark, d, "labels").select("doc_id", "quality")
    text = F.regexp_replace(F.col("text"), "\\r\\n|\\r|\\n|\\t", " ")
    line = F.when(F.col("quality").isNull(), text) \
        .otherwise(F.concat(text, F.lit("\t"), F.col("quality").cast("string")))
    return docs.join(labels, "doc_id", "left").select("doc_id", line.alias("value"))


def tsv_lines_label_first(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text"], spread_key="doc_id")
    labels = read_table(spark, d, "labels").select("doc_id", "quality")
    text = F.regexp_replace(F.col("text"), "\\r\\n|\\r|\\n|\\t", " ")
    line = F.concat(F.col("quality").cast("string"), F.lit("\t"), text)
    return docs.join(labels, "doc_id").select("doc_id", line.alias("value"))


def sensor_readings(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    marker = F.col("event_type") == "error"
    cal = F.get_json_object("props", "$.k").try_cast("int")
    return ev.select(
        F.col("user_id").alias("session_id"),
        "ts", "event_id",
        bucket_start("ts", SENSOR_BATCH).alias("batch"),
        F.when(marker, F.lit(-1)).otherwise(F.col("value").try_cast("int")).alias("heart_rate"),
        F.when(marker, F.lit(-1)).otherwise(cal).alias("calorie"),
        marker.alias("is_marker"),
    )


def sensor_lines(spark: SparkSession, d: str) -> DataFrame:
    """(event_id, value): `uuid,heart_rate,calorie` lines of the events. The UUID
    comes from an MD5 of the user; an `error` event has a broken one, and an
    event without a calorie value leaves the field empty."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "event_type", "value", "props")
    h = F.md5(F.col("user_id").cast("string"))
    uuid = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    line = F.concat(F.when(F.col("event_type") == "error", F.substring(uuid, 2, 40)).otherwise(uuid), F.lit(","),
                    F.coalesce(F.col("value").try_cast("int").cast("string"), F.lit("")), F.lit(","),
                    F.coalesce(F.get_json_object("props", "$.k"), F.lit("")))
    return ev.select("event_id", line.alias("value"))


def turn_words(spark: SparkSession, d: str) -> DataFrame:
    """(batch, word): words of the lines of the conversations, a turn a batch."""
    turns = read_table(spark, d, "conversations").select("turn", "text")
    lines = turns.select(F.col("turn").alias("batch"), F.explode(lines_of("text")).alias("line"))
    return lines.select("batch", F.explode(java_split("line")).alias("word"))


def event_words(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("ts", "event_type")
    return ev.select(F.col("event_type").alias("word"), bucket_start("ts", WORD_BATCH).alias("batch"))


def tweet_json(ev: DataFrame):
    return F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id_str"),
        F.date_format("ts", TS_FORMAT).alias("created_at"),
        F.col("event_type").alias("text"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k")))


def kafka_records(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return as_kafka_records(ev, key=F.col("user_id"), value=tweet_json(ev), topic=KAFKA_TOPIC,
                            partition=F.pmod(F.col("user_id"), F.lit(KAFKA_PARTITIONS)),
                            offset=F.col("event_id"), timestamp=F.col("ts"))


def users(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return c.select(F.col("c_custkey").alias("userid"), F.col("c_name").alias("username"),
                    (F.col("c_acctbal") >= 0).alias("enabled"))


def user_roles(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderpriority")
    return o.select(F.col("o_custkey").alias("userid"), F.col("o_orderpriority").alias("role"))

"""Kafka-shaped records.

`kafka_options` builds the options for Spark's `kafka` source (the connector
jar is not part of this image, so it is only exercised where present).
`as_kafka_records` renders any table as rows of the Kafka source schema so the
downstream operators can be tested on the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the columns of Spark's Kafka source.
KAFKA_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")


# Default: the most records of a micro-batch; without it, the first batch from the
# earliest offsets would be the whole topic.
MAX_OFFSETS_PER_TRIGGER = 1_000_000


def kafka_options(bootstrap_servers: str, topics: str | list[str], starting_offsets: str = "earliest",
                  security_protocol: str | None = None, kerberos_service_name: str | None = None,
                  group_id: str | None = None, min_partitions: int | None = None,
                  max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER, extra: dict | None = None) -> dict:
    """Options for `spark.read/readStream.format('kafka')`.

    `topics` is a comma list or a list (subscribe); a `SASL_PLAINTEXT` +
    Kerberos consumer sets `security_protocol` and `kerberos_service_name`;
    `min_partitions` plays the part of a fixed number of consumer threads.
    Offsets are tracked in the query checkpoint, so no group id is needed.
    """
    if isinstance(topics, (list, tuple)):
        topics = ",".join(topics)
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topics,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if security_protocol:
        opts["kafka.security.protocol"] = security_protocol
    if kerberos_service_name:
        opts["kafka.sasl.kerberos.service.name"] = kerberos_service_name
        opts.setdefault("kafka.sasl.mechanism", "GSSAPI")
    if group_id:
        opts["kafka.group.id"] = group_id
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra or {})
    return opts


def read_kafka(spark: SparkSession, options: dict, stream: bool = True) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load()


def kafka_value(df: DataFrame) -> DataFrame:
    """Record -> its value as text (keeps offsets for auditing)."""
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                     "topic", "partition", "offset", "timestamp")


def as_kafka_records(df: DataFrame, key: Column, value: Column, topic: str, partition: Column,
                     offset: Column, timestamp: Column) -> DataFrame:
    """Render rows in the Kafka source schema (key/value as binary)."""
    return df.select(
        F.encode(key.cast("string"), "UTF-8").alias("key"),
        F.encode(value.cast("string"), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        timestamp.alias("timestamp"),
    )

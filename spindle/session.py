"""Session helpers.

Library code never sets the master; `build_session` exists for tests, the bench
and local runs only. Checkpoint folders always come from the session
(`spark.checkpoint.dir`); a private folder is created only when that is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session built here gets; on a cluster they come from spark-defaults.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "spindle", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.setdefault("spark.driver.memory", os.environ.get("SPINDLE_DRIVER_MEMORY", "8g"))
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset.

    On a cluster `spark.checkpoint.dir` names a shared (distributed) folder and is
    used as is; if it is unset there, this fails rather than fall back to a
    machine-local folder that other executors cannot see. Local-mode runs
    (tests, the bench) get a fresh scratch folder.
    """
    current = checkpoint_dir(spark)
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="spindle-ckpt-", dir=os.environ.get("SPINDLE_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        value = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf access can fail on some builds
        value = None
    if not value:
        try:
            value = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover
            value = None
    return value or None


def streaming_checkpoint(spark: SparkSession, query_name: str) -> str:
    """One checkpoint folder per streaming query, under the shared folder."""
    root = spark.conf.get("spark.sql.streaming.checkpointLocation", None) or checkpoint_dir(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir (or pass checkpoint_location) for streaming queries")
    return f"{root.rstrip('/')}/streams/{query_name}"


# Sizing targets for cluster runs.
TARGET_SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
TARGET_SPLIT_BYTES = 256 * 1024 * 1024
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


# The largest shuffle of the queries, as a share of the input, where it is not
# known: partial aggregates and pruned columns come before every shuffle.
SHUFFLE_SHARE = 0.1


def cluster_settings(input_bytes: int, total_cores: int, shuffle_bytes: int | None = None) -> dict:
    """Settings for a cluster run over `input_bytes` of input on `total_cores`.

    * shuffle partitions: ~256 MB each of the largest shuffle (`shuffle_bytes`,
      by default SHUFFLE_SHARE of the input), at least 2 per core; map status on
      the driver grows with map tasks times these, so they follow what is
      shuffled and not what is read;
    * scan splits of 256 MB;
    * skew join: a partition 5x the median and over 512 MB is split;
    * broadcast only what is measured under 64 MB at run time (AQE), never a
      side whose size is unknown at planning;
    * RocksDB state store with changelog checkpoints, so streaming state
      (sessions, words, windows) lives off-heap and commits incrementally. Streams
      take `stream_settings` on top.
    """
    moved = int(input_bytes * SHUFFLE_SHARE) if shuffle_bytes is None else int(shuffle_bytes)
    shuffle = max(2 * total_cores, -(-moved // TARGET_SHUFFLE_PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_SHUFFLE_PARTITION_BYTES // 2),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(TARGET_SPLIT_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def stream_settings(total_cores: int) -> dict:
    """Settings for a streaming application: its shuffle partitions are its state
    stores, fixed by the first run of a checkpoint, so they follow the cores."""
    return {"spark.sql.shuffle.partitions": str(max(1, total_cores))}

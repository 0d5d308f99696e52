"""Line streams. A socket source is for demos (no replay, no fault tolerance);
the replayable equivalent is a folder of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def file_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)

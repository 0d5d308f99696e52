"""JDBC tables (user / role lookups). Filters on the returned DataFrame are
pushed into the database query (`PushedFilters` in the plan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_properties(user: str, password: str | None = None, driver: str | None = None,
                    fetch_size: int = 10_000) -> dict:
    props = {"user": user, "fetchsize": str(fetch_size)}
    if password is not None:
        props["password"] = password
    if driver:
        props["driver"] = driver
    return props


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              columns: list[str] | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Read a table; a numeric `partition_column` with bounds splits the read
    into `num_partitions` parallel range queries."""
    if partition_column:
        df = spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                             upperBound=upper_bound, numPartitions=num_partitions,
                             properties=properties)
    else:
        df = spark.read.jdbc(url, table, properties=properties)
    return df.select(*columns) if columns else df

"""Keyed upserts: the newest record per key wins, as with a put on a
wide-column store.

The newest row is picked with `max(struct(order..., values...))`, a partial
aggregate: each task keeps one row per key before the shuffle, so a key that
holds a third of the input ships one row per task, not a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | list[str], order: list[str], values: list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    newest = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in values]))
    return (df.groupBy(*keys).agg(newest.alias("_n"))
            .select(*keys, *[F.col(f"_n.{c}").alias(c) for c in order + values if c not in keys]))


def to_cells(df: DataFrame, key: str, family: str, columns: dict[str, str]) -> DataFrame:
    """Rows -> cells `(row_key, family, qualifier, value)`; `columns` maps a
    qualifier to the source column. Null keys are left out (see `null_keys`)."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(q).alias("qualifier"), F.col(c).cast("string").alias("value"))
        for q, c in columns.items()]))
    return (df.filter(F.col(key).isNotNull())
            .select(F.col(key).cast("string").alias("row_key"), F.lit(family).alias("family"),
                    cells.alias("_c"))
            .select("row_key", "family", "_c.qualifier", "_c.value"))


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows that cannot be stored because their key is null (reject table)."""
    return df.filter(F.col(key).isNull())

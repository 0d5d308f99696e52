"""Union, subtract (keeping left duplicates), sampling and repeatable splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by column name; duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def subtract_keep_duplicates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows with no equal row on the right (null-safe on every column).

    Unlike EXCEPT (distinct) or EXCEPT ALL, a left row that appears twice and
    is absent on the right stays twice, which is what an RDD `subtract` does.
    Only a SHA-256 of each right row is shuffled, not its columns; the left side
    is matched by the same digest of its own.
    """
    def digest(df: DataFrame) -> Column:
        cells = [F.when(df[c].isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.length(df[c].cast("string")).cast("string"),
                 F.lit(":"), df[c].cast("string"))) for c in left.columns]
        return F.sha2(F.concat(*cells), 256)

    gone = right.select(digest(right).alias("_digest"))
    return left.withColumn("_digest", digest(left)).join(gone, "_digest", "left_anti").drop("_digest")


def sample_fraction(df: DataFrame, fraction: float, seed: int, with_replacement: bool = False) -> DataFrame:
    """Bernoulli sample per row (Spark's sampler). Repeatable only for the same
    input partitioning; use `hash_bucket` for a split that never changes."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


# Prime modulus and multiplier of the repeatable split hash.
SPLIT_MODULUS = 1_000_003
SPLIT_MULTIPLIER = 7_919


def hash_bucket(id_col: str | Column, seed: int = 11, buckets: int = 100) -> Column:
    """A stable pseudo-random bucket in [0, buckets) from an integer id; plain
    integer arithmetic, so SQL engines compute the same bucket."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    mixed = F.pmod(F.pmod(c, F.lit(SPLIT_MODULUS)) * SPLIT_MULTIPLIER + seed, F.lit(SPLIT_MODULUS))
    return F.pmod(mixed, F.lit(buckets))


def hash_split(df: DataFrame, id_col: str, fraction: float, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """(train, test) with `fraction` of ids in train.

    test = the rows not in train. Because the split is a function of the id,
    two equal rows always land on the same side, so `subtract(df, train)`
    (see `subtract_keep_duplicates`) is exactly the complement filter used
    here - same rows, duplicates and null ids included, without a join that
    would shuffle every column of both sides."""
    in_train = F.coalesce(hash_bucket(id_col, seed) < int(round(fraction * 100)), F.lit(False))
    return df.filter(in_train), df.filter(~in_train)

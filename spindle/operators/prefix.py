"""Cumulative sums over one global order, and area under the ROC curve.

A window with an ORDER BY and no PARTITION BY moves every row into one task.
Here the order is cut into as many ranges as there are shuffle partitions, each
range is scanned in its own task, and the ranges' offsets come from a window
over their totals, one row per range. Rows are expected to be pre-aggregated per
distinct order value, so no single value can overload a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ranges(df: DataFrame, order: str, blocks: int | None) -> DataFrame:
    parts = df.repartitionByRange(order) if blocks is None else df.repartitionByRange(blocks, order)
    return parts.withColumn("_block", F.spark_partition_id())


def global_cumsum(df: DataFrame, order: str, values: list[str], blocks: int | None = None,
                  inclusive: bool = True, prefix: str = "cum_") -> DataFrame:
    """`df` with `{prefix}{v}`, the running sum of each value in `order` (unique).

    Range totals and rows come from one exchange: a row's total before its range
    is joined in from a table with one row per range."""
    blocked = _ranges(df, order, blocks)
    totals = blocked.groupBy("_block").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    wt = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_block", *[F.coalesce(F.sum(f"_t_{v}").over(wt), F.lit(0)).alias(f"_o_{v}")
                                        for v in values])
    frame = (0 if inclusive else -1)
    wl = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, frame)
    out = blocked.join(offsets, "_block")
    for v in values:
        out = out.withColumn(f"{prefix}{v}", F.col(f"_o_{v}") + F.coalesce(F.sum(v).over(wl), F.lit(0)))
    return out.drop("_block", *[f"_o_{v}" for v in values])


def auc_rank_sum(scored: DataFrame, score: str = "score", label: str = "label", blocks: int | None = None) -> DataFrame:
    """Area under ROC with ties counted half (the Mann-Whitney statistic, equal
    to the exact trapezoid area). One row: auc, n_pos, n_neg.

    Per distinct score: positives and negatives (partial aggregate). Each range of
    scores counts its own P, N and U = sum_s pos_s * (neg_below_s + neg_s / 2);
    ranges merge in score order as U + U_b + P_b * N_before, so scored rows are
    read once and nothing is joined back.
    """
    per = (scored.groupBy(F.col(score).cast("double").alias("_s"))
           .agg(F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).alias("pos"),
                F.sum(F.when(F.col(label) > 0, 0).otherwise(1)).alias("neg")))
    below = Window.partitionBy("_block").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    local = _ranges(per, "_s", blocks).withColumn("_below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    ranges = local.groupBy("_block").agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("n"),
        F.sum(F.col("pos") * (F.col("_below") + F.col("neg") / 2.0)).alias("u"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    merged = ranges.withColumn("u", F.col("u") + F.col("p") * F.coalesce(F.sum("n").over(before), F.lit(0)))
    return (merged.agg(F.sum("u").alias("_u"), F.sum("p").alias("n_pos"), F.sum("n").alias("n_neg"))
            .select(F.try_divide(F.col("_u"), F.col("n_pos") * F.col("n_neg")).alias("auc"),  # null if one class is absent
                    F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg")))

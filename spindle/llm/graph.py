"""Connected components of an edge list, as joins and sums over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import stage


def components(edges: DataFrame, name: str) -> DataFrame:
    """edges (a, b) of longs -> (node, root), root the smallest node reachable.

    Each round takes the smallest label among a node and its neighbours, then
    follows the label's own label (pointer jumping), until nothing changes;
    rounds grow with the logarithm of the longest path. Only the number of
    changed rows reaches the driver. Labels are written each round, so a hub's
    edges meet them in a join of two exchanges, which adaptive execution may
    split, and lost executors cost one round at most."""
    # Small star: a node keeps an edge to its smallest neighbour, and its other smaller neighbours
    # get one to that too. The nodes stay connected, and most edges of shared hubs fall together.
    down = edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("low < high").distinct()
    down = stage(down, f"{name}-down")
    least = stage(down.groupBy("high").agg(F.min("low").alias("least")), f"{name}-least")
    across = down.join(least, "high").where("low != least").select(F.col("low").alias("a"), F.col("least").alias("b"))
    kept = least.select(F.col("high").alias("a"), F.col("least").alias("b")).unionAll(across)
    both = stage(kept.unionAll(kept.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), f"{name}-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")) \
            .agg(F.min("root").alias("low"))
        lower = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "low").alias("root"))
        lower = stage(lower, f"{name}-lower")
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = stage(lower.join(jump, "root").select("node", "old", F.col("top").alias("root")), f"{name}-labels")
        if labels.where("old != root").isEmpty():
            return labels.select("node", "root")
        labels = labels.select("node", "root")

"""Linear SVM by full-batch subgradient steps, each one aggregate over the rows.

The objective of the original trainer: hinge loss plus an L2 penalty, no intercept,
step size `step` / sqrt(t). A step is one pass: every row's margin with the current
weights, then for each feature the sum of label times value over the rows inside
the margin (partial sums before the shuffle, one row of sums after it). The weights
of each step are written, so a run that was stopped goes on from its last step, and
what a step needs of the one before is one row with a number per feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _written(spark: SparkSession, path: str) -> int:
    """The last step whose weights are written, 0 if none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return 0
    steps = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(at)]
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return max((n for n in steps if fs.exists(path_of(f"{path}/step={n}/_SUCCESS"))), default=0)


def svm_weights(rows: DataFrame, features: int, iterations: int, path: str, step: float = 1.0, reg_param: float = 0.01) -> DataFrame:
    """(bucket, weight) after `iterations` steps over `rows` (label 0 or 1, features:
    an array of `features` numbers). The weights of step t are in `path`/step=t; a
    path that holds some is continued. Rows without a label or features count
    nowhere; without rows the weights stay 0."""
    spark = rows.sparkSession
    rows = rows.where("label IS NOT NULL AND features IS NOT NULL").select((2 * F.col("label") - 1).alias("y"), F.col("features").alias("x"))
    done = _written(spark, path)
    weights = [0.0] * features
    if done:
        weights = spark.read.parquet(f"{path}/step={done}").first()["weights"]
    for t in range(done + 1, iterations + 1):
        margin = F.aggregate(F.zip_with("x", F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w), F.lit(0.0), lambda a, b: a + b)
        inside = rows.select("x", F.when(F.col("y") * margin < 1, F.col("y")).otherwise(F.lit(0.0)).alias("y"))
        sums = inside.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("y") * F.get("x", F.lit(j))).alias(f"s{j}") for j in range(features)])
        rate = step / t ** 0.5
        new = [F.lit(w * (1 - rate * reg_param)) + F.coalesce(F.lit(rate) * F.col(f"s{j}") / F.col("n"), F.lit(0.0)) for j, w in enumerate(weights)]
        sums.select(F.array(*new).alias("weights")).write.mode("overwrite").parquet(f"{path}/step={t}")
        weights = spark.read.parquet(f"{path}/step={t}").first()["weights"]
    return spark.createDataFrame(list(enumerate(weights)), "bucket int, weight double")


def margins(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """`rows` with `score`, the margin under the weights (a row per feature)."""
    w = F.array(*[F.lit(r["weight"]) for r in weights.orderBy("bucket").collect()])
    return rows.withColumn("score", F.aggregate(F.zip_with("features", w, lambda x, y: x * y), F.lit(0.0), lambda a, b: a + b))

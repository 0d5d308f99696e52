"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, -ln(u) / quality, from a hash of its
id and text, so reruns agree. Within a source, documents stand in key order and
their sizes are prefix-summed up to the source's token budget. A source whose
target exceeds its size first gives whole epochs (each document once per
epoch); only the rest of the target is selected by key. The document at the
edge gives the words that the budget has left.

Targets: sources in code-point order (null last) weigh 1, 2, 3, 1, ... and
share all words of the corpus; a target stops at `max_epochs` times its
source's size and the excess goes to the others by weight. That is one water
level: sort sources by size / weight and find the first one below its cap, all
with running sums.

Hot sources: the prefix sum is two-level. Keys fall into `blocks` ranges
(uniform, as keys are exponential), a small table carries the sums across the
ranges of a source, and each (source, range) is one window of its own.

Nulls and edge cases: null text has size 0 and is taken 0 times; null sources
form a source of their own; null ids draw a key like any other; identical rows
tie and are interchangeable; an empty table gives an empty result; columns of
the input that clash with the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spindle.llm.common import or_empty, quoted, running_sums, stage, table, without, word_count

# Fixed values.
SOURCE_WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BLOCKS = 1024
SEED = "mix-1"
SYMBOLS = "#*$%&|<>!"

RESULT = ("size", "source_size", "target", "taken")


def quality_weight(text: Column) -> Column:
    """Document quality in [0.25, 1]: falls with the share of symbols."""
    t = or_empty(text)
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    return F.when(F.length(t) == 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.25), F.lit(1.0) - F.lit(5.0) * symbols / F.length(t)))


def uniform(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from a hash of the id and the text."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(or_empty(text)))
    bits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = SOURCE_WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(src, size) -> (src, source_size, target); src is a non-null sort key."""
    ranked = running_sums(sizes.select("src", F.col("size").cast("long").alias("size")), ["src"], [], "mix-sources")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")
    caps = ranked.select("src", "size", weight.alias("weight")) \
        .withColumn("cap", F.col("size") * F.lit(max_epochs)) \
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    filled = running_sums(caps, ["ratio", "src"], ["cap", "weight"], "mix-targets")
    totals = filled.agg(F.struct(F.sum("size").alias("words"), F.sum("weight").alias("weights")).alias("t")).scalar()
    level = (totals["words"] - F.col("before_cap")).cast("double") / (totals["weights"] - F.col("before_weight"))
    levels = filled.select("ratio", level.alias("level"))
    water = levels.where("level <= ratio").agg(F.min(F.struct("ratio", "level"))["level"]).scalar()
    target = F.when(F.col("ratio") < water, F.col("cap").cast("double")).otherwise(water * F.col("weight"))
    return filled.select("src", F.col("size").alias("source_size"),
                         F.least(target, F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, quality: Column | None = None, weights: tuple[int, ...] = SOURCE_WEIGHTS,
        max_epochs: int = MAX_EPOCHS, blocks: int = BLOCKS, seed: str = SEED, text: str = "text",
        keep_text: bool = True) -> DataFrame:
    """`docs` (doc_id, source and a text column at least) with size,
    source_size, target and taken (the words the mix takes of the document,
    repeats counted). `quality` weighs documents; without it, `quality_weight`."""
    body = quoted(text)
    key = -F.log(uniform(quoted("doc_id"), body, seed)) / (quality if quality is not None else quality_weight(body))
    src = F.when(quoted("source").isNull(), F.lit("z")).otherwise(F.concat(F.lit("s"), quoted("source").cast("string")))
    kept = without(docs, RESULT if keep_text else (*RESULT, text))
    names = [c for c in docs.columns if c.lower() not in {*RESULT, *([] if keep_text else [text.lower()])}]
    thin = docs.select(*kept, src.alias("__src"), word_count(body).alias("size"), key.alias("__key"),
                       F.md5(or_empty(body)).alias("__tie"))
    block = F.least(F.lit(blocks - 1), F.floor((F.lit(1.0) - F.exp(-F.col("__key"))) * blocks)).cast("int")
    thin = stage(thin.withColumn("__block", block), "mix-docs")

    sums = stage(thin.groupBy("__src", "__block").agg(F.sum("size").alias("words")), "mix-blocks")
    sizes = sums.groupBy(F.col("__src").alias("src")).agg(F.sum("words").alias("size"))
    targets = stage(source_targets(sizes, weights, max_epochs), "mix-shares")
    prior = W.partitionBy("__src").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    carry = sums.select("__src", "__block", F.coalesce(F.sum("words").over(prior), F.lit(0)).alias("__carry"))
    plan = stage(carry.join(targets.withColumnRenamed("src", "__src"), "__src"), "mix-plan")

    earlier = W.partitionBy("__src", "__block").orderBy("__key", "doc_id", "size", "__tie") \
        .rowsBetween(W.unboundedPreceding, -1)
    rows = thin.join(plan, ["__src", "__block"])
    before = F.col("__carry") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rows = rows.withColumn("__before", before).withColumn("__epochs", epochs.cast("long"))
    rest = F.col("target") - (F.col("__epochs") * F.col("source_size")).cast("double")
    part = F.floor(F.greatest(F.lit(0.0), F.least(F.col("size").cast("double"), rest - F.col("__before")))).cast("long")
    return rows.select(*[quoted(c) for c in names], "size", "source_size", "target",
                       (F.col("__epochs") * F.col("size") + part).alias("taken"))


def op9_mix(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = table(spark, data_dir, "documents", "doc_id", "source", "text")
    return mix(docs, keep_text=False).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = f"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 's' || source END AS src, coalesce(text, '') AS t FROM documents
), k AS (
  SELECT doc_id, src, md5(t) AS tie, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(t)), 1, 13))::BIGINT::DOUBLE + 0.5)
             / 4503599627370496.0)
         / CASE WHEN length(t) = 0 THEN 1.0::DOUBLE
                ELSE greatest(0.25::DOUBLE, 1.0::DOUBLE - 5.0::DOUBLE * (length(t) - length(translate(t, '{SYMBOLS}', '')))::DOUBLE / length(t)::DOUBLE) END
         AS key
  FROM d
), s AS (
  SELECT src, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::BIGINT AS weight FROM k GROUP BY src
), r AS (
  SELECT *, (3 * source_size)::DOUBLE / weight AS ratio FROM s
), f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM r WINDOW w AS (ORDER BY ratio, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), v AS (
  SELECT min(struct_pack(ratio := ratio, level := level)).level AS water FROM f WHERE level <= ratio
), g AS (
  SELECT src, source_size, CASE WHEN ratio < water THEN (3 * source_size)::DOUBLE
         ELSE least(water * weight, (3 * source_size)::DOUBLE) END AS target FROM f, v
), h AS (
  SELECT k.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size)::BIGINT ELSE 0 END AS epochs,
         coalesce(sum(size) OVER (PARTITION BY k.src ORDER BY key, doc_id NULLS FIRST, size, tie
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN g USING (src)
)
SELECT doc_id, size, source_size, target,
       (epochs * size + floor(greatest(0.0::DOUBLE, least(size::DOUBLE, (target - (epochs * source_size)::DOUBLE) - before::DOUBLE)))::BIGINT)::BIGINT AS taken
FROM h
"""

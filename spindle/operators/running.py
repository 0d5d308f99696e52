"""Per-key running totals over ordered batches, with reset rules.

This is the batch (replay) form of the stateful stream jobs: given one row per
(key, step) with that step's sums, it returns the state after every step.

Plan shape, chosen for skew: a key may hold a third of all rows, so the scan is
never one window over a whole key. Steps are grouped into chunks (a coarser,
order-preserving bucket such as the day of an hourly batch):

  1. window over (key, chunk): local running sums and the base at the last reset;
  2. one summary row per (key, chunk): total since its last reset, reset flag;
  3. window over the summaries of a key (one row per chunk, small): the carry
     each chunk receives from the chunks before it;
  4. join the carry back on (key, chunk) and add it where no reset came first.

Resets are expressed as "running sum minus the running sum just before the
latest reset", so each level needs a single window (one sort, one shuffle).
Values are integers here, so the subtraction is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _last_reset_base(cum: Column, contrib: Column, reset: Column, w) -> Column:
    return F.last(F.when(reset, cum - contrib), ignorenulls=True).over(w)


def running_totals(df: DataFrame, key: str | list[str], order: str | list[str], values: list[str],
                   reset: Column | None = None, reset_values: dict | None = None,
                   chunk: Column | None = None, prefix: str = "") -> DataFrame:
    """Running sums of `values` per key in `order`.

    `reset`: boolean Column; on such a row the state restarts and the row
    contributes `reset_values[v]` (default 0) instead of its own value.
    `chunk`: optional Column, monotone in `order`, that splits long keys into
    independent pieces (see module doc). Output keeps every input column and
    adds `{prefix}{v}` running columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_cols = [order] if isinstance(order, str) else list(order)
    reset_values = reset_values or {}
    flag = (reset if reset is not None else F.lit(False))
    base = df.withColumn("_reset", F.coalesce(flag, F.lit(False)))
    contrib = {v: F.when(F.col("_reset"), F.lit(reset_values.get(v, 0)).cast("bigint"))
               .otherwise(F.col(v).cast("bigint")) for v in values}
    base = base.select("*", *[c.alias(f"_c_{v}") for v, c in contrib.items()])

    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        out = base
        for v in values:
            out = out.withColumn(f"_cum_{v}", F.sum(f"_c_{v}").over(w))
        for v in values:
            b = _last_reset_base(F.col(f"_cum_{v}"), F.col(f"_c_{v}"), F.col("_reset"), w)
            out = out.withColumn(f"{prefix}{v}", F.col(f"_cum_{v}") - F.coalesce(b, F.lit(0)))
        return out.drop("_reset", *[f"_c_{v}" for v in values], *[f"_cum_{v}" for v in values])

    # Level 1: inside each (key, chunk).
    base = base.withColumn("_chunk", chunk)
    w1 = Window.partitionBy(*keys, "_chunk").orderBy(*order_cols) \
        .rowsBetween(Window.unboundedPreceding, 0)
    loc = base.withColumn("_seen_reset", F.max(F.col("_reset").cast("int")).over(w1))
    for v in values:
        loc = loc.withColumn(f"_cum_{v}", F.sum(f"_c_{v}").over(w1))
    for v in values:
        b = _last_reset_base(F.col(f"_cum_{v}"), F.col(f"_c_{v}"), F.col("_reset"), w1)
        loc = loc.withColumn(f"_loc_{v}", F.col(f"_cum_{v}") - F.coalesce(b, F.lit(0)))

    # Level 2: one summary per (key, chunk); the last row of a chunk holds the
    # chunk's total since its last reset.
    last = F.max(F.struct(*[F.col(c) for c in order_cols],
                          *[F.col(f"_loc_{v}").alias(v) for v in values]))
    summ = loc.groupBy(*keys, "_chunk").agg(
        F.max(F.col("_reset").cast("int")).alias("_has_reset"), last.alias("_last"))
    w2 = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    for v in values:
        tail = F.col(f"_last.{v}")
        cum = F.sum(tail).over(w2)
        summ = summ.withColumn(f"_ccum_{v}", cum)
    for v in values:
        tail = F.col(f"_last.{v}")
        b = F.last(F.when(F.col("_has_reset") == 1, F.col(f"_ccum_{v}") - tail), ignorenulls=True).over(w2)
        summ = summ.withColumn(f"_run_{v}", F.col(f"_ccum_{v}") - F.coalesce(b, F.lit(0)))
    w2p = Window.partitionBy(*keys).orderBy("_chunk")
    at = {c: f"_at_{i}" for i, c in enumerate([*keys, "_chunk"])}
    carry = summ.select(*[F.col(c).alias(a) for c, a in at.items()],
                        *[F.coalesce(F.lag(f"_run_{v}").over(w2p), F.lit(0)).alias(f"_carry_{v}")
                          for v in values])

    # Null-safe: a null key or a null order is a group like any other.
    same = [F.col(c).eqNullSafe(F.col(a)) for c, a in at.items()]
    out = loc.join(carry, on=reduce(lambda x, y: x & y, same), how="inner").drop(*at.values())
    for v in values:
        out = out.withColumn(f"{prefix}{v}", F.col(f"_loc_{v}") +
                             F.when(F.col("_seen_reset") == 1, F.lit(0)).otherwise(F.col(f"_carry_{v}")))
    drop = ["_reset", "_chunk", "_seen_reset"]
    for v in values:
        drop += [f"_c_{v}", f"_cum_{v}", f"_loc_{v}", f"_carry_{v}"]
    return out.drop(*drop)


def state_as_of(states: DataFrame, key: str | list[str], order: str, at=None) -> DataFrame:
    """Every key's state as of step `at` (the full per-batch output of a state
    stream), by default the last one: the latest row per key with order <= at. A max over a struct is a
    partial aggregate, so a hot key does not gather in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in states.columns if c not in keys and c != order]
    latest = F.max(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("_s")
    upto = states if at is None else states.filter(F.col(order) <= F.lit(at))
    return (upto.groupBy(*keys).agg(latest)
            .select(*keys, F.col(f"_s.{order}").alias(order), *[F.col(f"_s.{c}").alias(c) for c in rest]))


def every_state(states: DataFrame, key: str, step: str, value: str, steps: DataFrame, chunk: int) -> DataFrame:
    """(key, step, value) of every key at every step from its first state on: the
    full output that a state stream repeats each batch.

    `states` has a row where a key's value changes; `step` is a whole number and
    `steps` the steps there are. A state holds until the next one, so it is a
    stretch of steps. Stretches are cut at multiples of `chunk`: inside a chunk the
    next state is found among the key's rows there, and a key's last state of a chunk
    is carried into each chunk up to its next one, so no task expands a key's whole
    history. Null steps are no batch and are left out."""
    s = states.where(F.col(step).isNotNull()).select(F.col(key).alias("_key"), F.col(step).cast("bigint").alias("_at"), F.col(value).alias("_value")) \
        .withColumn("_chunk", F.floor(F.col("_at") / chunk))
    inside = Window.partitionBy("_key", "_chunk").orderBy("_at")
    own = s.select("_key", "_at", F.coalesce(F.lead("_at").over(inside), (F.col("_chunk") + 1) * chunk).alias("_until"), "_value")
    ends = s.groupBy("_key", "_chunk").agg(F.min("_at").alias("_first"), F.max(F.struct("_at", "_value"))["_value"].alias("_value"))
    by_key = Window.partitionBy("_key").orderBy("_chunk")
    most = steps.agg(F.floor(F.max(F.col(step).cast("bigint")) / chunk).alias("m")).scalar()
    last = F.coalesce(F.lead("_chunk").over(by_key), most)
    ends = ends.select("_key", "_value", "_chunk", last.alias("_last"), F.lead("_first").over(by_key).alias("_change"))
    carried = ends.where("_last > _chunk").select("_key", "_value", "_last", "_change", F.explode(F.sequence(F.col("_chunk") + 1, F.col("_last"))).alias("_c"))
    stop = F.when(F.col("_c") == F.col("_last"), F.coalesce("_change", (F.col("_c") + 1) * chunk)).otherwise((F.col("_c") + 1) * chunk)
    stretches = own.unionByName(carried.select("_key", (F.col("_c") * chunk).alias("_at"), stop.alias("_until"), "_value")).where("_until > _at")
    each = stretches.select("_key", "_value", F.explode(F.sequence(F.col("_at"), F.col("_until") - 1)).alias("_step"))
    there = steps.where(F.col(step).isNotNull()).select(F.col(step).cast("bigint").alias("_step")).distinct()
    return each.join(there, "_step").select(F.col("_key").alias(key), F.col("_step").alias(step), F.col("_value").alias(value))

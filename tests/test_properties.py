"""Property tests: the Column helpers and the chunked state scan against plain
Python models, on random inputs (one Spark job per example batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindle.functions.text import java_split, tokenize
from spindle.operators.running import running_totals

WS = "[ \t\n\x0b\f\r]"


def java_split_model(s: str, pattern: str):
    """Java String.split(regex) with limit 0, as plain Python."""
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


TEXT = st.text(alphabet=st.sampled_from(["a", "b", "C", " ", "\t", "\n", ",", "É"]), max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_java_split_and_tokenize_match_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select(java_split("s", " ").alias("sp"), java_split("s", ",").alias("cm"),
                    tokenize("s").alias("tk")).collect()
    for t, r in zip(texts, got):
        assert r.sp == java_split_model(t, " ")
        assert r.cm == java_split_model(t, ",")
        assert r.tk == java_split_model(t.lower(), WS)


BATCH = st.lists(st.tuples(st.sampled_from(["k1", "k2"]), st.integers(0, 30),
                           st.sampled_from([(-1, -1), (70, 2), (0, 0), (5, 1), (-2, 0), (1, -1)])),
                 min_size=1, max_size=60)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(BATCH)
def test_reset_rule_matches_fold(spark, rows):
    flat = [(k, b, v[0], v[1]) for k, b, v in rows]
    df = spark.createDataFrame(flat, "k string, b long, hr long, cal long")
    per = df.groupBy("k", "b").agg(F.sum("hr").alias("hr"), F.sum("cal").alias("cal"), F.count(F.lit(1)).alias("n"))
    reset = (F.col("hr") == -1) & (F.col("cal") == -1)
    out = running_totals(per, "k", "b", ["hr", "cal", "n"], reset=reset, reset_values={"n": 1},
                         chunk=F.floor(F.col("b") / 4), prefix="t_")
    got = {(r.k, r.b): (r.t_hr, r.t_cal, r.t_n) for r in out.collect()}
    want = {}
    for k in {r[0] for r in flat}:
        state = (0, 0, 0)
        for b in sorted({r[1] for r in flat if r[0] == k}):
            sel = [r for r in flat if r[0] == k and r[1] == b]
            hs, cs = sum(r[2] for r in sel), sum(r[3] for r in sel)
            state = (0, 0, 1) if (hs == -1 and cs == -1) else (state[0] + hs, state[1] + cs, state[2] + len(sel))
            want[(k, b)] = state
    assert got == want

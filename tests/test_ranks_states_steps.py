"""Ranks over ranges, every state at every step, SVM steps as sums."""

import os
import random

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spindle.operators import features as feat
from spindle.operators import models
from spindle.operators.ranking import ranked
from spindle.operators.running import every_state
from spindle.operators.setops import hash_split
from spindle.operators.subgradient import margins, svm_weights
from spindle.plans import derived
from tests.conftest import SF01


def test_ranks_across_ranges(spark, scratch):
    r = random.Random(1)
    rows = [(r.choice([None, 1, 2, 2, 2, 7]), f"w{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "n int, word string").repartition(5)
    got = ranked(df, [F.col("n").desc(), F.col("word").asc()], scratch)
    want = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert [(x.n, x.word) for x in got.orderBy("rank").collect()] == want
    assert sorted(x.rank for x in got.collect()) == list(range(1, 501))
    assert ranked(df.where("n > 100"), [F.col("word").asc()], scratch).count() == 0
    assert got.count() == 500  # a later call leaves the earlier result readable


def test_every_state_at_every_step(spark):
    r = random.Random(2)
    steps = sorted(r.sample(range(-20, 200), 90))
    states = [(k, s, 100 * s + i) for i, k in enumerate(["a", "b", None, "late"]) for s in r.sample(steps, 3 if k == "b" else 25) if k != "late" or s > 150]
    df = spark.createDataFrame([*states, ("a", None, 5)], "k string, step bigint, v bigint")
    there = spark.createDataFrame([(s,) for s in steps] + [(None,)], "step bigint")
    want = []
    for k in {k for k, _, _ in states}:
        own = {s: v for kk, s, v in states if kk == k}
        now = None
        for s in steps:
            now = own.get(s, now)
            if now is not None:
                want.append((k, s, now))
    for chunk in (1, 7, 1000):
        got = every_state(df, "k", "step", "v", there, chunk)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_svm_steps_reach_the_solver(spark, scratch):
    lab = derived.labelled_docs(spark, SF01)
    hashed = feat.hashed_tf(lab, 65).select("doc_id", "label", "rawFeatures")
    train, test = hash_split(hashed, "doc_id", 0.6, 11)
    idf = feat.fitted_idf(train)
    rows = lambda df: idf.transform(df).select("label", vector_to_array("features").alias("features"))
    path = f"{scratch}/steps"
    written = rows(train).cache()
    svm_weights(written, 65, 3, path)
    mark = os.path.getmtime(f"{path}/step=3")
    weights = svm_weights(written, 65, 45, path)  # goes on from step 3
    assert os.path.getmtime(f"{path}/step=3") == mark and os.path.exists(f"{path}/step=45/_SUCCESS")
    solver = models.fit_hashed(models.svm_pipeline(), train)
    ours = models.area_under_roc(margins(rows(test), weights)).first().auc
    theirs = models.area_under_roc(models.svm_scores(models.after_hashing(solver), test)).first().auc
    assert abs(ours - theirs) < 0.05
    assert {r.weight for r in svm_weights(written.where("label > 5"), 65, 2, f"{scratch}/none").collect()} == {0.0}

"""Multinomial Naive Bayes on exact-term TF-IDF, written as joins and
aggregates (the SQL form of `NaiveBayes(smoothing=1)` on a vocabulary).

For class c with n_c training docs (N in total), term sums s_cj of the
features and S_c = sum_j s_cj over a vocabulary of V terms:
  pi_c      = ln(n_c + a) - ln(N + K a)
  theta_cj  = ln(s_cj + a) - ln(S_c + V a)
  score_c(x) = pi_c + sum_j x_j theta_cj
             = pi_c + sum_j x_j ln(s_cj + a) - ln(S_c + V a) * sum_j x_j
With a = 1 the first sum only needs terms with s_cj > 0, so no (term x class)
grid is built. Classes are the binarized labels 0.0 and 1.0; ties go to 0.0,
like an argmax that takes the first maximum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.functions.text import tokenize
from spindle.operators.features import doc_tokens, own_exchange, term_frequencies

# Fixed value: the two classes produced by the label rule.
CLASSES = (0.0, 1.0)


def nb_exact(train: DataFrame, test: DataFrame, doc_id: str = "doc_id", text: str = "sentence",
             smoothing: float = 1.0) -> DataFrame:
    """`(doc_id, label, prediction)` for the test rows.

    One aggregate by term over the training rows gives the vocabulary table
    `(term, idf, s0, s1)`, which carries everything the test side needs (a single
    join, whose hot terms adaptive execution may split); the constants (V, S_c, n_c, N) come from two
    one-row aggregates used as scalar subqueries, never collected.
    """
    a = float(smoothing)
    k = float(len(CLASSES))
    labelled = train.select(doc_id, "label", F.explode(tokenize(F.col(text))).alias("term"))
    per_doc = labelled.groupBy(doc_id, "label", "term").agg(F.count(F.lit(1)).alias("tf"))
    ns = train.agg(F.struct(F.count(F.lit(1)).cast("double").alias("n"),
                            *[F.sum(F.when(F.col("label") == c, 1.0).otherwise(0.0)).alias(f"n{i}")
                              for i, c in enumerate(CLASSES)])).scalar()
    # A term's IDF is one number, so its class sums are IDF times its counts by class.
    counts = per_doc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), *[
        F.sum(F.when(F.col("label") == c, F.col("tf")).otherwise(0)).alias(f"t{i}") for i, c in enumerate(CLASSES)])
    idf = F.ln((ns["n"] + 1) / (F.col("df") + 1))
    vocab = counts.select("term", idf.alias("idf"), *[(idf * F.col(f"t{i}")).alias(f"s{i}") for i in range(len(CLASSES))])
    vs = vocab.agg(F.struct(F.count(F.lit(1)).cast("double").alias("v"),
                            *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(CLASSES))])).scalar()

    te_tf = term_frequencies(doc_tokens(test, doc_id, text), doc_id)
    te_x = te_tf.join(own_exchange(vocab, "term"), "term").select(doc_id, (F.col("tf") * F.col("idf")).alias("x"), "s0", "s1")
    sums = te_x.groupBy(doc_id).agg(*[F.sum(F.col("x") * F.ln(F.col(f"s{i}") + a)).alias(f"p{i}")
                                      for i in range(len(CLASSES))], F.sum("x").alias("sx"))
    scored = test.select(doc_id, "label").join(sums, doc_id, "left").na.fill(0.0, ["p0", "p1", "sx"])
    score = [F.ln(ns[f"n{i}"] + a) - F.ln(ns["n"] + k * a) + F.col(f"p{i}")
             - F.ln(vs[f"s{i}"] + vs["v"] * a) * F.col("sx") for i in range(len(CLASSES))]
    return scored.select(doc_id, "label", F.when(score[1] > score[0], F.lit(CLASSES[1]))
                         .otherwise(F.lit(CLASSES[0])).alias("prediction"))

"""Toxicity by cumulative-link ordinal regression.

Severity grades 0 to 3 share one weight vector over sparse text features; ordered
thresholds t1 < t2 < t3 turn a document's score s into P(grade >= j) =
sigmoid(s - tj). The expected severity is the sum of these probabilities, and a
document is toxic if P(grade >= 1) reaches one half.

Features are the words of a text and their first five and four characters
(as bytes), hashed into `BUCKETS`, each with 1 + log(count): stems catch words
that were never seen whole.

Labels say toxic or not. Grades come from them: 0 is not toxic; toxic documents
are cut at two quantiles of their number of marker words, which are the words
whose rate among toxic labelled documents exceeds that among others `MARKER_RATIO`
times.

Only features whose presence and the label are dependent get a weight: their
log-likelihood ratio (G squared) must reach `SCREEN`, which chance alone exceeds
in about one feature of 100,000, and their rates differ `LIFT` times, which common
words of longer texts do not.

The model is fitted on the driver from a bounded sample of labelled documents
(`SAMPLE`, in the order of a hash of the id); its weights, BUCKETS numbers, are
all that is broadcast. All documents are scored whole, in one pass without a
shuffle.

Nulls and edge cases: null text counts as empty and scores the baseline; labels
with null ids or null toxic are not used; repeated ids join each of their rows;
without any toxic or any other label every document scores the smoothed share of
toxic labels (0 without labels); an empty table gives an empty result; input
columns whose names clash with the result's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import textbytes as tb
from spindle.llm.common import quoted, table, without

# Fixed values.
SAMPLE = 8000
BUCKETS = 1 << 20
STEMS = (5, 4)
GRADES = 3
MARKER_RATIO = 8.0
MARKER_LEAST = 3
SCREEN = 20.0       # least log-likelihood ratio of a feature and the toxic label
LIFT = 3.0          # and least ratio of its rates among toxic and other documents, either way
RIDGE = 1e-5
STEPS = 300
RATE = 0.05
RESULT = ("severity", "grade", "toxic", "p_toxic")


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value, is whole word) of all features of a slice."""
    low = tb.LOWER[data]
    starts, ends, first = tb.word_bounds(low, offsets, tb.ALNUM)
    ranges = tb.Ranges(low)
    row = np.searchsorted(first, np.arange(len(starts)), side="right") - 1
    keys, rows, kinds = [], [], []
    for width in (0, *STEMS):
        stop = ends if width == 0 else starts + width
        own = np.arange(len(starts)) if width == 0 else np.flatnonzero(ends - starts > width)
        h = tb.mix64(ranges.of(starts[own], stop[own]) + (stop[own] - starts[own]).astype(np.uint64) * tb.U(8) + tb.U(width))
        keys.append(h % tb.U(BUCKETS))
        rows.append(row[own])
        kinds.append(np.full(len(own), width == 0))
    bucket, rows_, kind = np.concatenate(keys).astype(np.int64), np.concatenate(rows), np.concatenate(kinds)
    packed, n = np.unique((rows_ * BUCKETS + bucket) * 2 + kind, return_counts=True)
    return packed // 2 // BUCKETS, packed // 2 % BUCKETS, (1 + np.log(n)).astype(np.float32), packed % 2 == 1


class Ordinal:
    """Fitted weights (one per bucket) and thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """rows x GRADES: P(grade >= j)."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def grades(toxic: np.ndarray, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Severity grades of labelled rows from their numbers of marker words."""
    n_bad, n_good = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    bad = np.bincount(bucket[word & toxic[row]], minlength=BUCKETS)
    good = np.bincount(bucket[word & ~toxic[row]], minlength=BUCKETS)
    marker = (bad >= MARKER_LEAST) & ((bad / n_bad) > MARKER_RATIO * ((good + 0.5) / n_good))
    counts = np.exp(value - 1)
    marked = np.bincount(row[word], weights=(counts * marker[bucket])[word], minlength=len(toxic)).round()
    cut = np.quantile(marked[toxic], [1 / 3, 2 / 3])
    return np.where(toxic, 1 + (marked > cut[0]) + (marked > cut[1]), 0)


def dependence(toxic: np.ndarray, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """G squared of each bucket's presence against the label. A bucket that
    holds a word and a stem of the same row counts twice at most."""
    n, n_bad = len(toxic), int(toxic.sum())
    bad = np.minimum(np.bincount(bucket[toxic[row]], minlength=BUCKETS), n_bad).astype(float)
    good = np.minimum(np.bincount(bucket[~toxic[row]], minlength=BUCKETS), n - n_bad).astype(float)
    out = np.zeros(BUCKETS)
    for seen, side in ((bad, n_bad), (good, n - n_bad), (n_bad - bad, n_bad), (n - n_bad - good, n - n_bad)):
        total = bad + good if seen is bad or seen is good else n - bad - good
        expected = total * side / n
        out += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)
    return out


def fit(toxic: np.ndarray, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, word: np.ndarray) -> Ordinal:
    """Maximum penalised likelihood by Adam on the whole sample."""
    n = len(toxic)
    if n == 0 or toxic.all() or not toxic.any():
        share = (toxic.sum() + 0.5) / (n + 1) if n else 1e-9
        return Ordinal(np.zeros(BUCKETS, np.float32), -np.log(share / (1 - share)) + np.arange(GRADES, dtype=float))
    grade = grades(toxic, row, bucket, value, word)
    at_least = grade[:, None] >= np.arange(1, GRADES + 1)[None, :]
    rate = lambda side: (np.bincount(bucket[side[row]], minlength=BUCKETS) + 0.5) / (side.sum() + 0.5)
    told = ((dependence(toxic, row, bucket) >= SCREEN) & (np.abs(np.log(rate(toxic) / rate(~toxic))) >= np.log(LIFT)))[bucket]
    row, bucket, value = row[told], bucket[told], value[told]
    used, column = np.unique(bucket, return_inverse=True)
    w, cut = np.zeros(len(used)), np.log(np.maximum(1e-3, 1 - at_least.mean(0))) - np.log(np.maximum(1e-3, at_least.mean(0)))
    theta = np.concatenate([cut[:1], np.log(np.maximum(0.1, np.diff(cut)))])
    weight = np.where(toxic, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean()))[:, None] / n  # both sides count alike
    m1, m2 = np.zeros(len(w) + GRADES), np.zeros(len(w) + GRADES)
    for step in range(1, STEPS + 1):
        thresholds = theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))])
        s = np.bincount(row, weights=w[column] * value, minlength=n)
        up = 1.0 / (1.0 + np.exp(np.clip(thresholds[None, :] - s[:, None], -60, 60)))
        # P(grade = g) = up[g] - up[g + 1], with up[0] = 1 and up[GRADES + 1] = 0.
        full = np.concatenate([np.ones((n, 1)), up, np.zeros((n, 1))], axis=1)
        p = np.maximum(1e-12, full[np.arange(n), grade] - full[np.arange(n), grade + 1])
        slope = np.concatenate([np.zeros((n, 1)), up * (1 - up), np.zeros((n, 1))], axis=1)
        d_s = -(slope[np.arange(n), grade] - slope[np.arange(n), grade + 1]) / p * weight[:, 0]
        d_t = np.zeros(GRADES)
        for j in range(1, GRADES + 1):
            d_t[j - 1] = ((np.where(grade == j, slope[:, j], 0) - np.where(grade + 1 == j, slope[:, j], 0)) / p * weight[:, 0]).sum()
        g_theta = np.concatenate([[d_t.sum()], [d_t[j:].sum() * np.exp(theta[j]) for j in range(1, GRADES)]])
        g = np.concatenate([np.bincount(column, weights=d_s[row] * value, minlength=len(w)) + RIDGE * w, g_theta])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
        w, theta = w - move[:len(w)], theta - move[len(w):]
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w
    return Ordinal(weights, theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))]))


def fit_labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal:
    """Fit on at most `sample` labels (doc_id, toxic) joined with docs (doc_id, text)."""
    chosen = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", "toxic") \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # `sample` rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for lo, hi, data, offsets in tb.column_slices(batch.column("text")):
                row, bucket, value, word = _features(data, offsets)
                bounds = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32))
                cell = lambda x: pa.ListArray.from_arrays(bounds, pa.array(x))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(toxic[lo:hi] != 0), cell((bucket * 2 + word).astype(np.int32)), cell(value)],
                    ["doc_id", "toxic", "keys", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, toxic boolean, keys array<int>, counts array<float>") \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic", F.xxhash64("keys")).limit(sample).toArrow()
    if not found.num_rows:
        none = np.zeros(0, np.int64)
        return fit(np.zeros(0, bool), none, none, none.astype(np.float32), none.astype(bool))
    found = found.combine_chunks()
    keys, counts = found.column("keys").combine_chunks(), found.column("counts").combine_chunks()
    flat = keys.flatten().to_numpy().astype(np.int64)
    sizes = np.diff(keys.offsets.to_numpy())
    return fit(np.array(found.column("toxic").to_pylist(), bool), np.repeat(np.arange(found.num_rows), sizes), flat // 2,
               counts.flatten().to_numpy(), flat % 2 == 1)


def score(docs: DataFrame, model: Ordinal, text: str = "text", keep_text: bool = True) -> DataFrame:
    """`docs` with severity (expected grade), grade, toxic and p_toxic."""
    rest = without(docs, RESULT)
    body = docs.select(*rest)
    columns = [c for c in body.columns if keep_text or c != text]
    fields = ", ".join(f"`{c.replace('`', '``')}` {body.schema[c].dataType.simpleString()}" for c in columns)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Ordinal(*shared.value)
        for batch in batches:
            for lo, hi, data, offsets in tb.column_slices(batch.column(text)):
                row, bucket, value, _ = _features(data, offsets)
                up = own.probabilities(np.bincount(row, weights=own.weights[bucket] * value, minlength=hi - lo))
                severity = up.sum(1)
                most = np.argmax(-np.diff(np.concatenate([np.ones((hi - lo, 1)), up, np.zeros((hi - lo, 1))], axis=1), axis=1), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(lo, hi - lo) for c in columns], pa.array(severity), pa.array(most.astype(np.int32)),
                     pa.array(up[:, 0] >= 0.5), pa.array(up[:, 0])], [*columns, *RESULT])

    return body.mapInArrow(run, (fields + ", " if columns else "") + "severity double, grade int, toxic boolean, p_toxic double")


def op4_toxicity(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = table(spark, data_dir, "documents", "doc_id", "text")
    model = fit_labelled(docs, table(spark, data_dir, "labels", "doc_id", "toxic"))
    return score(docs, model, keep_text=False)

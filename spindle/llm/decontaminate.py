"""Benchmark decontamination by a prefix-filtered set join.

Item-sized windows (10 consecutive item words; a shorter item is one window)
are sets of word shingles. A document contains a window only if it contains its
rarest shingle, so that one shingle is the window's necessary prefix: with full
containment, prefix length |S| - |S| + 1 = 1. Rarity is counted over all
documents. The join matches document shingles with prefixes, then checks

* length: the window's words fit into the document;
* position: the window starts where its shingle's offset puts it;
* containment: all words of that stretch equal the window's, in order.

Two passes over the documents count and fetch shingles as byte hashes; both are
thinned by a bit table of fixed size (`FILTER_BITS`), so what is broadcast does
not grow with the benchmark. A fuller table only lets more candidates through to
the join, which is exact. Common passages make hot join keys; the join has its
own exchange on both sides, which adaptive execution may split.

Nulls and edge cases: null texts have no words (nothing is hit, no window);
repeated items count once per item id, a null id being one of its own and shown
as an empty string; identical documents give identical results, one row each;
empty tables on either side give empty or clean results; columns of `docs` whose
names clash with the result's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import textbytes as tb
from spindle.llm.common import quoted, stage, table, without

# Fixed values.
WINDOW = 10
SHINGLE = 3
FILTER_BITS = 1 << 23
RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids")


def _shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word index) of all k-word shingles that stay within a row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        h = tb.mix64(h * tb.U(tb.BASES[0]) + hashes[j:j + n])
    inside = np.ones(n, dtype=bool)
    for j in range(1, k):  # a shingle may not run over the first word of a later row
        at = first[1:-1] - j
        inside[at[(at >= 0) & (at < n)]] = False
    at = np.flatnonzero(inside)
    return h[at], at


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    low = tb.LOWER[data]
    starts, ends, first = tb.word_bounds(low, offsets, tb.ALNUM)
    return low, starts, ends, first, tb.mix64(tb.Ranges(low).of(starts, ends) + (ends - starts).astype(np.uint64))


def _phrase(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, i: int, j: int) -> str:
    raw = low[starts[i]:ends[j - 1]].tobytes()
    base = starts[i]
    return b" ".join(raw[s - base:e - base] for s, e in zip(starts[i:j].tolist(), ends[i:j].tolist())).decode("utf-8", "replace")


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, text) -> one row per window and shingle of it."""
    for batch in batches:
        out: list[tuple] = []
        for lo, hi, data, offsets in tb.column_slices(batch.column("text")):
            low, starts, ends, first, hashes = _tokens(data, offsets)
            for r in range(hi - lo):
                a, b = int(first[r]), int(first[r + 1])
                m = min(WINDOW, b - a)
                if m == 0:
                    continue
                k = min(SHINGLE, m)
                own = tb.as_long(_shingles(hashes[a:b], np.array([0, b - a]), k)[0]).tolist()
                item = batch.column("item_id")[lo + r].as_py()
                for w in range(b - a - m + 1):
                    text = _phrase(low, starts, ends, a + w, a + w + m)
                    out.extend((item, text, m, k, o, own[w + o]) for o in range(m - k + 1))
        cols = list(zip(*out)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
            pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["item", "window", "m", "k", "o", "g"])


def _bit_table(keys: DataFrame, bits: int) -> tuple[np.ndarray, list[int]]:
    """A bit table of the shingle hashes of `keys` (k, g), and the shingle sizes
    that occur. At most bits / 64 + SHINGLE rows reach the driver."""
    at = F.pmod(F.col("g"), F.lit(bits))
    rows = keys.groupBy(F.floor(at / 64).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))).alias("b")).toArrow()
    found = np.zeros(bits // 64, dtype=np.int64)
    found[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    sizes = sorted(r.k for r in keys.select("k").distinct().limit(SHINGLE).collect())  # k is 1 to SHINGLE
    return found.view(np.uint64), sizes


def _matches(table_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(table_) * 64
    at = (hashes.view(np.int64) % bits)  # like pmod: never negative
    return np.flatnonzero((table_[at >> 6] >> (at & 63).astype(np.uint64)) & tb.U(1))


def _rarity(docs: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """(k, g, n): how often candidate shingles occur in all documents."""
    found, sizes = _bit_table(keys, bits)
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in tb.column_slices(batch.column("text")):
                _, _, _, first, hashes = _tokens(data, offsets)
                for k in sizes:
                    h, _ = _shingles(hashes, first, k)
                    g, n = np.unique(h[_matches(shared.value, h)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), k, np.int32)), pa.array(tb.as_long(g)),
                                                      pa.array(n.astype(np.int64))], ["k", "g", "n"])

    return docs.select("text").mapInArrow(count, "k int, g long, n long").groupBy("k", "g").agg(F.sum("n").alias("n"))


def _candidates(docs: DataFrame, prefixes: DataFrame, bits: int) -> DataFrame:
    """(__id, n_words, found array<(k, g, p, at, around)>): where shingles that
    may be prefixes stand, with the words around them."""
    found, sizes = _bit_table(prefixes.select("k", "g"), bits)
    shared = docs.sparkSession.sparkContext.broadcast(found)
    cell = pa.struct([("k", pa.int32()), ("g", pa.int64()), ("p", pa.int64()), ("at", pa.int64()), ("around", pa.string())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tb.column_slices(batch.column("text")):
                low, starts, ends, first, hashes = _tokens(data, offsets)
                cells: list[list[dict]] = [[] for _ in range(hi - lo)]
                for k in sizes:
                    h, at = _shingles(hashes, first, k)
                    hit = _matches(shared.value, h)
                    rows = np.searchsorted(first, at[hit], side="right") - 1
                    for i, g, r in zip(at[hit].tolist(), tb.as_long(h[hit]).tolist(), rows.tolist()):
                        a, b = max(int(first[r]), i - WINDOW + k), min(int(first[r + 1]), i + WINDOW)
                        cells[r].append({"k": k, "g": g, "p": i - int(first[r]), "at": a - int(first[r]),
                                         "around": _phrase(low, starts, ends, a, b)})
                yield pa.RecordBatch.from_arrays([
                    batch.column("__id").slice(lo, hi - lo), pa.array(np.diff(first[:hi - lo + 1]).astype(np.int64)),
                    pa.array(cells, pa.list_(cell))], ["__id", "n_words", "found"])

    return docs.mapInArrow(fetch, "__id long, n_words long, found array<struct<k:int,g:long,p:long,at:long,around:string>>")


def find_items(docs: DataFrame, items: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """docs (__id, text) and items (item_id, text) -> (__id, n_words, n_hit,
    item_ids): words inside any occurrence of an item window, and whose."""
    shingles = items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(
        _windows, "item string, window string, m int, k int, o int, g long")
    shingles = stage(shingles, "decon-windows")
    rarity = stage(_rarity(docs, shingles, filter_bits), "decon-rarity")
    ranked = shingles.select("window", "m", "k", "o", "g").distinct().join(rarity, ["k", "g"])  # an absent shingle rules its window out
    whole = ranked.groupBy("window", "m").agg(F.min(F.struct("n", "o", "k", "g")).alias("s"), F.count(F.lit(1)).alias("present"))
    prefixes = stage(whole.where(F.col("present") == F.col("m") - F.col("s.k") + 1)
                     .select("window", "m", "s.k", "s.g", "s.o"), "decon-prefixes")
    thin = stage(_candidates(docs, prefixes, filter_bits), "decon-candidates")
    cells = thin.select("__id", "n_words", F.explode("found").alias("c")).select("__id", "n_words", "c.*")
    start = F.col("p") - F.col("o")
    near = cells.join(prefixes, ["k", "g"]).where((start >= 0) & (start + F.col("m") <= F.col("n_words")))
    here = F.array_join(F.slice(F.split("around", " "), (start - F.col("at") + 1).cast("int"), F.col("m")), " ")
    hits = stage(near.where(here == F.col("window")).select("__id", start.alias("start"), "m", "window"), "decon-hits")

    spans = hits.groupBy("__id").agg(F.sort_array(F.collect_set(F.struct("start", "m"))).alias("s"))
    covered = F.aggregate("s", F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")), lambda acc, x: F.struct(
        F.greatest(acc["end"], x["start"] + x["m"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0).cast("long"), x["start"] + x["m"] - F.greatest(acc["end"], x["start"]))).alias("n")),
        lambda acc: acc["n"])
    owners = stage(shingles.select("item", "window").distinct(), "decon-owners")
    owned = hits.select("__id", "window").distinct().join(owners, "window").groupBy("__id").agg(
        F.sort_array(F.collect_set(F.coalesce("item", F.lit("")))).alias("item_ids"))
    counted = spans.select("__id", covered.alias("n_hit")).join(owned, "__id")
    return thin.select("__id", "n_words").join(counted, "__id", "left").select(
        "__id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """`docs` with n_words, n_hit, n_items, items_sha256, contaminated, item_ids."""
    rest = without(docs, RESULT)
    # The row id is drawn and fixed by a written table, so that every later stage agrees on it.
    rows = stage(docs.select(*rest, F.monotonically_increasing_id().alias("__id")), "decon-docs")
    found = find_items(rows.select("__id", quoted(text).alias("text")), items)
    back = [quoted(c) for c in rows.columns if c != "__id" and (keep_text or c != text)]
    ids = F.col("item_ids")
    return rows.select("__id", *back).join(found, "__id").select(
        *back, "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), ids.alias("item_ids"))


def op2_decontaminate(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = table(spark, data_dir, "documents", "doc_id", "text")
    items = table(spark, data_dir, "benchmark", "item_id", "text")
    return decontaminate(docs, items, keep_text=False).drop("item_ids")


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP2_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS w FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWERED}, '{_WORD}') AS w FROM benchmark
), v AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS m, array_to_string(list_slice(w, i, i + least(len(w), {WINDOW}) - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM b WHERE len(w) > 0)
), g AS (
  SELECT rid, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS win
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM v))
), h AS (
  SELECT rid, i, m, item FROM g JOIN v USING (m, win)
), s AS (
  SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS x FROM (SELECT DISTINCT rid, i, m FROM h)) GROUP BY rid
), o AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN s USING (rid) LEFT JOIN o USING (rid)
"""

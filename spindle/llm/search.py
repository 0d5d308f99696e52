"""Ranked lexical search of many queries at once, by shared sums.

A document's score for an item is a sum over the item's terms, so items that
share terms share parts of that sum. For a block of items the plan is a graph of
sums, mined once:

* leaves are terms (with their number of repeats in the item); terms that occur
  in exactly the same items form one class;
* while two classes or sums occur together in two items or more, the pair that
  most items share becomes a sum of its own and stands for both in these items
  (pairs are counted in stretches of `STRETCH` members, so mining stays linear in
  the size of the block);
* an item is the sum of what is left in it.

Every document evaluates the graph once: the values of its leaves go in, each
shared sum is materialised once as an accumulator, and the items read them. The
graph decides only how a sum is bracketed, so scores do not depend on it.

Spark's part: documents are scanned once against the vocabulary of the items and
written as narrow rows (id, number of terms, matching terms and counts); document
counts and frequencies are aggregates of these rows; the scoring pass reads them,
keeps the best rows of each item per task (a top-k of the whole needs no others)
and one window ranks these. Items come in blocks of bounded size (`BLOCK_ITEMS`,
`BLOCK_TERMS`), and what is broadcast is a block's vocabulary and graph.

Scores: integers as stated at `OP12_SQL`; only a term's weight uses doubles.

Nulls and edge cases: null or term-free texts of documents have no terms, count
nowhere and are never ranked; null or term-free items return no row; null ids are
kept (a null document id sorts last among equal scores); repeated items are
ranked each, repeated documents are documents each; ties go by document id; long
texts are split in stretches of bytes; an empty table gives an empty result;
other columns of the input are not read, so none can clash.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spindle.llm.common import quoted, running_sums, stage, table

# Fixed values.
TOP = 10
BLOCK_ITEMS = 256       # items of a block, and
BLOCK_TERMS = 1 << 15   # terms of its items together (a single longer item is a block of its own)
STRETCH = 64            # members of an item among which pairs are counted
CELLS = 1 << 22         # accumulators of a slice of documents
TEXT_BYTES = 1 << 20    # bytes of a text split at once
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def count_terms(text: str | None) -> Counter:
    """The terms of a text (bytes, A-Z lower-cased) and their counts."""
    data = (text or "").encode().translate(TERM_BYTES)
    if len(data) <= TEXT_BYTES:
        return Counter(data.split())
    counts, at = Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + TEXT_BYTES)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


@dataclass
class Graph:
    """Sums over numbered nodes. Nodes 0..leaves-1 are leaves: `leaf_term` and
    `leaf_repeats`. Level by level, the nodes from `starts[i]` on are sums of the
    nodes in `members` between their `bounds`. `roots[i]` is the node of item i,
    or -1 if it has no terms."""

    leaf_term: np.ndarray
    leaf_repeats: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    roots: np.ndarray
    nodes: int
    additions: int

    def evaluate(self, acc: np.ndarray) -> None:
        """Fill the sums of `acc` (nodes x documents) from its leaves."""
        for own, members, bounds in self.levels:
            acc[own] = np.add.reduceat(acc[members], bounds, axis=0)


def _share(items: list[list[int]], first: int) -> tuple[dict[int, tuple[int, int]], list[list[int]]]:
    """Greedy shared pairs: {new node: (a, b)} and what is left of each item.
    Nodes from `first` on are new."""
    parts = [set(item[at:at + STRETCH]) for item in items for at in range(0, len(item), STRETCH)]
    owner = [i for i, item in enumerate(items) for _ in range(0, len(item), STRETCH)]
    holds: dict[tuple[int, int], set[int]] = {}
    pair = lambda a, b: (a, b) if a < b else (b, a)
    for number, part in enumerate(parts):
        members = sorted(part)
        for i, a in enumerate(members):
            for b in members[i + 1:]:
                holds.setdefault((a, b), set()).add(number)
    heap = [(-len(where), p) for p, where in holds.items() if len(where) > 1]
    heapq.heapify(heap)
    made: dict[int, tuple[int, int]] = {}
    while heap:
        n, (a, b) = heapq.heappop(heap)
        where = holds.get((a, b), set())
        if len(where) < 2:
            continue
        if len(where) != -n:  # counted before some of its parts changed
            heapq.heappush(heap, (-len(where), (a, b)))
            continue
        node = first + len(made)
        made[node] = (a, b)
        fresh: set[tuple[int, int]] = set()
        for number in list(where):
            part = parts[number]
            part -= {a, b}
            for c in part:
                holds[pair(a, c)].discard(number)
                holds[pair(b, c)].discard(number)
                holds.setdefault((c, node), set()).add(number)
                fresh.add((c, node))
            part.add(node)
        del holds[(a, b)]
        for p in fresh:
            if len(holds[p]) > 1:
                heapq.heappush(heap, (-len(holds[p]), p))
    left: list[list[int]] = [[] for _ in items]
    for number, part in enumerate(parts):
        left[owner[number]].extend(sorted(part))
    return made, left


def mine(items: list[dict[int, int]]) -> Graph:
    """The graph of sums of some items, given as {term: repeats}."""
    leaves = sorted({pair for item in items for pair in item.items()})
    number = {pair: i for i, pair in enumerate(leaves)}
    within: dict[int, list[int]] = {}
    for i, item in enumerate(items):
        for pair in item.items():
            within.setdefault(number[pair], []).append(i)
    classes: dict[tuple[int, ...], list[int]] = {}
    for leaf, where in within.items():
        classes.setdefault(tuple(where), []).append(leaf)
    sums: dict[int, list[int]] = {}
    node = len(leaves)
    held: list[list[tuple[int, int]]] = [[] for _ in items]
    for where, members in classes.items():
        if len(members) > 1:
            sums[node] = members
            own, node = node, node + 1
        else:
            own = members[0]
        for i in where:
            held[i].append((-len(where), own))
    # Widely shared classes stand together; those of a single item share nothing.
    shared = [[c for n, c in sorted(item) if n < -1] for item in held]
    alone = [[c for n, c in sorted(item) if n == -1] for item in held]
    made, left = _share(shared, node)
    sums.update({n: list(p) for n, p in made.items()})
    node += len(made)
    roots = np.full(len(items), -1, dtype=np.int64)
    for i, item in enumerate(items):
        members = left[i] + alone[i]
        if len(members) > 1:
            sums[node] = members
            roots[i], node = node, node + 1
        elif members:
            roots[i] = members[0]
    depth: dict[int, int] = {}
    levels: dict[int, list[int]] = {}
    for own in sorted(sums):  # members have smaller numbers
        depth[own] = 1 + max(depth.get(m, 0) for m in sums[own])
        levels.setdefault(depth[own], []).append(own)
    packed = []
    for d in sorted(levels):
        sizes = [len(sums[n]) for n in levels[d]]
        packed.append((np.array(levels[d]), np.array([m for n in levels[d] for m in sums[n]]),
                       np.concatenate([[0], np.cumsum(sizes[:-1])]).astype(np.int64)))
    return Graph(np.array([t for t, _ in leaves], dtype=np.int64), np.array([r for _, r in leaves], dtype=np.int64), packed, roots,
                 node, sum(len(m) - 1 for m in sums.values()))


def matches(docs: DataFrame, vocabulary: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n, terms, counts) of each document with a term: how many terms its
    text has, and which of the vocabulary, by number, how often."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows, sizes, terms, counts, bounds = [], [], [], [], [0]
            for row, text_ in enumerate(batch.column(1)):
                found = count_terms(text_.as_py())
                if not found:
                    continue
                rows.append(row)
                sizes.append(found.total())
                for term in found.keys() & known.keys():
                    terms.append(known[term])
                    counts.append(found[term])
                bounds.append(len(terms))
            at = pa.array(np.array(bounds, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))],
                ["doc", "n", "terms", "counts"])

    return docs.select(quoted(key), quoted(text)).mapInArrow(run, f"doc {kind}, n long, terms array<int>, counts array<bigint>")


class _Best:
    """The `top` best documents of each item of a task, by score and then id."""

    def __init__(self, items: int, top: int):
        self.top, self.items = top, items
        self.least = np.zeros(items, dtype=np.int64)
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """scores: items x documents; a score of 0 is no hit."""
        item, doc = np.nonzero((scores >= self.least[:, None]) & (scores > 0))
        if len(item):
            self.rows.append((item, scores[item, doc], missing[doc], ids[doc]))
            self.waiting += len(item)
            if self.waiting > 64 * self.top * self.items:
                self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        if not self.rows:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        item, score, missing, ids = (np.concatenate(c) for c in zip(*self.rows))
        order = np.lexsort((ids, missing, -score, item))
        item, score, missing, ids = (c[order] for c in (item, score, missing, ids))
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.top
        last = place == self.top - 1
        self.least[item[last]] = score[last]
        self.rows = [(item[kept], score[kept], missing[kept], ids[kept])]
        self.waiting = int(kept.sum())
        return self.rows[0]


def best_documents(found: DataFrame, graph: Graph, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, doc, score): the best rows of each task, which hold the best of all."""
    shared = found.sparkSession.sparkContext.broadcast((graph, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = shared.value
        order = np.argsort(own.leaf_term, kind="stable")  # a term's leaves: one for each number of repeats
        first = np.searchsorted(own.leaf_term[order], np.arange(len(w) + 1))
        with_terms = np.flatnonzero(own.roots >= 0)
        best = _Best(len(with_terms), top)
        width = max(1, CELLS // max(1, own.nodes))
        for whole in batches:
            for lo in range(0, whole.num_rows, width):
                batch = whole.slice(lo, width)
                terms, counts = batch.column("terms"), batch.column("counts")
                sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
                term = terms.flatten().to_numpy().astype(np.int64)
                tf = counts.flatten().to_numpy()
                doc = np.repeat(np.arange(batch.num_rows), sizes)
                m = np.array([100 - 75 + 75 * n * n_docs // n_terms for n in batch.column("n").to_pylist()], dtype=np.int64)
                value = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                many = first[term + 1] - first[term]
                leaf = order[np.repeat(first[term] - np.cumsum(many) + many, many) + np.arange(many.sum())]
                acc = np.zeros((own.nodes, batch.num_rows), dtype=np.int64)
                acc[leaf, np.repeat(doc, many)] = np.repeat(value, many) * own.leaf_repeats[leaf]
                own.evaluate(acc)
                ids = batch.column("doc")
                best.add(acc[own.roots[with_terms]], pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False))
        item, score, missing, ids = best.prune()
        yield pa.RecordBatch.from_arrays(
            [pa.array(with_terms[item.astype(np.int64)].astype(np.int32)), pa.array(ids.astype(np.int64), mask=missing.astype(bool)), pa.array(score.astype(np.int64))],
            ["item", "doc", "score"])

    return found.mapInArrow(run, "item int, doc long, score long")


def item_blocks(items: DataFrame, key: str = "item_id", text: str = "text") -> list[DataFrame]:
    """The items in blocks of at most BLOCK_ITEMS rows and, but for single items,
    about BLOCK_TERMS terms: (rank, item_id, text)."""
    thin = items.select(quoted(key).alias("item_id"), quoted(text).alias("text"), F.sha2(F.coalesce(quoted(text), F.lit("")), 256).alias("digest"),
                        (F.coalesce(F.length(quoted(text)), F.lit(0)) / 2).cast("long").alias("size"))
    ranked = running_sums(thin, ["item_id", "digest"], ["size"], "search-items")
    block = F.concat_ws(":", F.floor((F.col("rank") - 1) / BLOCK_ITEMS), F.floor(F.col("before_size") / BLOCK_TERMS))
    blocked = stage(ranked.select("rank", "item_id", "text", block.alias("block")), "search-blocks")
    names = [r["block"] for r in blocked.select("block").distinct().orderBy("block").toLocalIterator()]
    return [blocked.where(F.col("block") == name) for name in names]


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of each item."""
    spark, results = docs.sparkSession, []
    for block in item_blocks(items):
        rows = block.orderBy("rank").collect()  # a block is bounded
        counted = [count_terms(r["text"]) for r in rows]
        vocabulary = sorted({t for c in counted for t in c})
        number = {t: i for i, t in enumerate(vocabulary)}
        graph = mine([{number[t]: n for t, n in c.items()} for c in counted])
        found = stage(matches(docs, vocabulary), "search-matches")
        totals = found.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not totals["docs"] or not vocabulary:
            continue
        df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
        frequency = np.zeros(len(vocabulary), dtype=np.int64)
        for r in df:  # at most the block's vocabulary
            frequency[r["term"]] = r["df"]
        weights = np.floor(1000 * np.log((2 * totals["docs"] + 2) / (2 * frequency + 1))).astype(np.int64)
        best = best_documents(found, graph, weights, totals["docs"], totals["terms"], top)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")
        results.append(best.join(F.broadcast(names), "item").withColumn("row", F.col("item") + F.lit(rows[0]["rank"])))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    place = F.row_number().over(W.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    return every.withColumn("rank", place).where(F.col("rank") <= top).select("item_id", "rank", F.col("doc").alias("doc_id"), "score")


def op12_search(spark: SparkSession, data_dir: str) -> DataFrame:
    return search(table(spark, data_dir, "documents", "doc_id", "text"), table(spark, data_dir, "benchmark", "item_id", "text"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), n AS (
  SELECT row, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0
), s AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM n
), tf AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY row, term
), q AS (
  SELECT item, item_id, term, count(*)::BIGINT AS repeats FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark))
  GROUP BY item, item_id, term
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, s WHERE term IN (SELECT term FROM q) GROUP BY term, docs
), scored AS (
  SELECT q.item, q.item_id, tf.row, n.doc_id,
         sum(q.repeats * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 75 + ((75 * n.n * s.docs) // s.all_terms)))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n USING (row), s GROUP BY q.item, q.item_id, tf.row, n.doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

"""MinHash near-dedup with sequential Bayesian verification.

1. One pass hashes every document's word shingles to a set of 64-bit numbers, a
   128-bit digest of that set and banded MinHash keys. Documents with equal sets
   form a class; only classes go on, so groups of exact copies cost one member.
2. Classes that share a band key are candidates. Each bucket links its members
   to its smallest one, and the connected groups of these stars are the clusters
   within which any candidate pair must lie - no pair is ever listed.
3. A cluster is cut into blocks of a bounded number of members and shingles. A
   block and `PIVOTS` members of the whole cluster are one bounded piece of work.
   Within it, candidates (pairs that share a band) compare signatures batch by
   batch: with m of n hashes equal and a uniform prior, the posterior probability
   that the similarity reaches the threshold is a binomial tail, and pairs below
   `MISS` are dropped. Survivors are verified on the full sets. A piece returns a
   spanning forest of its verified links.
4. Members that these links join need no comparison with each other. Bands whose
   members are all joined are closed; the others cluster anew, and what is not in
   the largest joined part of such a cluster meets, block by block, the cluster.
   So the rows of a group of copies grow with its members; only candidates that
   stay apart cost pairs of blocks.
5. Connected components of all links give every document its group.

The number of bands makes a pair exactly at the threshold share none with a
probability below `BAND_MISS`. Sets hold 64-bit shingle hashes.

Nulls and edge cases: null or wordless texts have an empty set and are linked
with nothing; null ids join a group but never name it unless no other id is
there; identical rows share a group and, having the same id, are kept alike; an
empty table gives an empty result; a very long text is one member whose set is
verified whole; only the needed columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import textbytes as tb
from spindle.llm.common import quoted, stage, table
from spindle.llm.graph import components

# Fixed values.
BAND_MISS = 1e-7
MISS = 1e-6
BATCH = 32
BLOCK_MEMBERS = 128
BLOCK_SHINGLES = 100_000
PIVOTS = 8


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows per band) for a similarity threshold in percent."""
    rows = 6 if percent >= 85 else 5
    return math.ceil(math.log(BAND_MISS) / math.log(1 - (percent / 100) ** rows)), rows


def least_matches(percent: int, hashes: int, miss: float = MISS) -> list[tuple[int, int]]:
    """(n, m): after n hashes, fewer than m equal ones leave a posterior below
    `miss` that the similarity reaches the threshold. Uniform prior: the
    posterior is Beta(m + 1, n - m + 1), its tail P(Bin(n + 1, t) <= m)."""
    t, out = percent / 100, []
    for n in sorted({*range(BATCH, hashes, BATCH), hashes}):
        tail, m = 0.0, 0
        while m <= n:
            tail += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                             + m * math.log(t) + (n + 1 - m) * math.log(1 - t))
            if tail >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def _multipliers(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    x = tb.mix64(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * tb.U(tb.BASES[0]))
    return x[:hashes] | tb.U(1), x[hashes:]


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within a row, and row bounds."""
    low = tb.LOWER[data]
    starts, ends, first = tb.word_bounds(low, offsets, tb.SPACES)
    words = tb.mix64(tb.Ranges(low).of(starts, ends) + (ends - starts).astype(np.uint64))
    n_words = np.diff(first)
    values, rows = [], []
    for k in range(1, width + 1):  # fewer words than `width`: the whole sequence is one shingle
        n = len(words) - k + 1
        if n <= 0:
            continue
        h = np.full(n, k, dtype=np.uint64)
        for j in range(k):
            h = tb.mix64(h * tb.U(tb.BASES[1]) + words[j:j + n])
        row = np.searchsorted(first, np.arange(n), side="right") - 1
        own = (np.arange(n) + k <= first[row + 1]) & ((n_words[row] == k) if k < width else True)
        values.append(h[own])
        rows.append(row[own])
    if not values:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    value, row = np.concatenate(values), np.concatenate(rows)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(len(offsets)))


def _digests(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums for each non-empty row."""
    return tuple(np.add.reduceat(tb.mix64(values ^ tb.U(b)), bounds[:-1]) for b in tb.BASES)


def _signatures(values: np.ndarray, bounds: np.ndarray, hashes: int) -> np.ndarray:
    """rows x hashes minima; no row may be empty."""
    a, b = _multipliers(hashes)
    out = np.empty((len(bounds) - 1, hashes), dtype=np.uint64)
    for i in range(hashes):
        out[:, i] = np.minimum.reduceat(values * a[i] + b[i], bounds[:-1])
    return out


def _band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(signatures), bands), dtype=np.uint64)
    for j in range(bands):
        h = np.full(len(signatures), j + 1, dtype=np.uint64)
        for r in range(rows):
            h = tb.mix64(h * tb.U(tb.BASES[0]) + signatures[:, j * rows + r])
        out[:, j] = h
    return out


def _profile(docs: DataFrame, key: str, width: int, percent: int) -> DataFrame:
    """(key, text) -> (key, n_shingles, s1, s2, bands)."""
    bands, rows = bands_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tb.column_slices(batch.column("text")):
                values, bounds = _sets(data, offsets, width)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                s1, s2 = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
                keys = np.zeros((0, bands), np.uint64)
                if len(full):
                    own = np.append(bounds[full], len(values))
                    d1, d2 = _digests(values, own)
                    s1[full], s2[full] = tb.as_long(d1), tb.as_long(d2)
                    keys = _band_keys(_signatures(values, own, bands * rows), bands, rows)
                ends = np.zeros(hi - lo + 1, np.int32)
                np.cumsum((sizes > 0) * bands, out=ends[1:])
                yield pa.RecordBatch.from_arrays([
                    batch.column(key).slice(lo, hi - lo), pa.array(sizes.astype(np.int64)), pa.array(s1), pa.array(s2),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(tb.as_long(keys.ravel())))],
                    [key, "n_shingles", "s1", "s2", "bands"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, n_shingles long, s1 long, s2 long, bands array<long>")


def _verify(pieces: DataFrame, percent: int) -> DataFrame:
    """(root, i, j, block, node, part, members binary) -> links (a, b): a
    spanning forest of the verified links of each piece (root, i, j). Members of
    one part are not compared, nor those of one block unless i = j."""
    pieces = pieces.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "block", "node")
    bands, rows = bands_for(percent)
    hashes, checks = bands * rows, least_matches(percent, bands * rows)

    def links_of(nodes: list[int], blocks: list[int], parts: list[int], sets: list[np.ndarray], cross: bool) -> list[tuple[int, int]]:
        at = {n: i for i, n in enumerate(nodes)}  # a class that comes twice (a repeated row) counts once
        keep = sorted(at.values())
        nodes, sets = [nodes[i] for i in keep], [sets[i] for i in keep]
        side, part = np.array([blocks[i] for i in keep]), np.array([parts[i] for i in keep])
        if len(nodes) < 2:
            return []
        sizes = np.array([len(s) for s in sets])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        values = np.concatenate(sets)
        sig = _signatures(values, bounds, hashes)
        keys = _band_keys(sig, bands, rows)
        share = np.zeros((len(nodes), len(nodes)), dtype=bool)
        for j in range(bands):
            share |= keys[:, j][:, None] == keys[:, j][None, :]
        share &= part[:, None] != part[None, :]
        if cross:
            share &= side[:, None] != side[None, :]
        x, y = np.nonzero(np.triu(share, 1))
        small, large = np.minimum(sizes[x], sizes[y]), np.maximum(sizes[x], sizes[y])
        fits = 100 * small >= percent * large  # the similarity is at most small / large
        x, y = x[fits], y[fits]
        matched, done = np.zeros(len(x), dtype=np.int64), 0
        for n, least in checks:  # sequential test on one more batch of hashes
            if not len(x):
                return []
            matched += (sig[x, done:n] == sig[y, done:n]).sum(axis=1)
            alive = matched >= least
            x, y, matched, done = x[alive], y[alive], matched[alive], n
        both = _intersections(values, bounds, x, y)
        ok = 100 * both >= percent * (sizes[x] + sizes[y] - both)
        parent = list(range(len(nodes)))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        out = []
        for i, j in zip(x[ok].tolist(), y[ok].tolist()):
            a, b = find(i), find(j)
            if a != b:
                parent[b] = a
                out.append((nodes[i], nodes[j]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, nodes, blocks, parts, sets = None, [], [], [], []

        def flush() -> pa.RecordBatch:
            found = links_of(nodes, blocks, parts, sets, piece[1] != piece[2]) if nodes else []
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()),
                                               pa.array([p[1] for p in found], pa.int64())], ["a", "b"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("root", "i", "j", "block", "node", "part")]
            members = batch.column("members")
            for r, (root, i, j, block, node, part) in enumerate(zip(*cols)):
                if (root, i, j) != piece:
                    if piece is not None:
                        yield flush()
                    piece, nodes, blocks, parts, sets = (root, i, j), [], [], [], []
                nodes.append(node)
                blocks.append(block)
                parts.append(part)
                sets.append(np.frombuffer(members[r].as_buffer(), dtype=np.uint64).copy())
        if piece is not None:
            yield flush()

    return pieces.mapInArrow(run, "a long, b long")


def _intersections(values: np.ndarray, bounds: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of pairs of rows."""
    rows = len(bounds) - 1
    if len(x) <= 2 * rows:
        return np.array([len(np.intersect1d(values[bounds[i]:bounds[i + 1]], values[bounds[j]:bounds[j + 1]], assume_unique=True))
                         for i, j in zip(x.tolist(), y.tolist())], dtype=np.int64)
    _, column = np.unique(values, return_inverse=True)
    row = np.repeat(np.arange(rows), np.diff(bounds))
    total = np.zeros((rows, rows), dtype=np.float64)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    step = 4096
    for lo in range(0, int(column[-1]) + 1, step):
        a, b = np.searchsorted(column, [lo, lo + step])
        table_ = np.zeros((rows, step), dtype=np.float32)
        table_[row[a:b], column[a:b] - lo] = 1
        total += table_ @ table_.T
    return total[x, y].astype(np.int64)


def _blocks(count: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(count / BLOCK_MEMBERS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _block(first: Column, blocks: Column) -> Column:
    """One of the `blocks` block numbers from `first` on, by the node."""
    return (first + F.pmod(F.xxhash64("node"), F.greatest(blocks, F.lit(1)).cast("long"))).cast("int")


def _open_pieces(members: DataFrame, sets: DataFrame, banded: DataFrame, links: DataFrame) -> DataFrame:
    """Pieces for the candidates of clusters of several blocks that `links` has
    not joined: all that is outside a cluster's largest part, against the cluster."""
    parts = components(links, "near-parts").withColumnRenamed("root", "part")
    large = members.where("blocks > 1").select("node", "n").join(parts, "node", "left")
    large = stage(large.select("node", "n", F.coalesce("part", "node").alias("part")), "near-large")
    bands = stage(banded.join(large.select("node", "part"), "node"), "near-large-bands")
    still = stage(bands.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.min("node").alias("hub"))
                  .where("low < high").select("band", "hub"), "near-open-bands")
    stars = bands.join(still, "band").where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    open_ = stage(components(stars, "near-open").join(large, "node"), "near-open-members")
    by_part = open_.groupBy("root", "part").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    most = F.max(F.struct("c", "n", "part"))
    cut = by_part.groupBy("root").agg(most.alias("m"), F.sum("c").alias("c"), F.sum("n").alias("n")).select(
        "root", F.col("m.part").alias("main"), _blocks(F.col("m.c"), F.col("m.n")).alias("inner"),
        _blocks(F.col("c") - F.col("m.c"), F.col("n") - F.col("m.n")).alias("outer"))
    placed = open_.join(stage(cut, "near-open-sizes"), "root")
    own = F.when(F.col("part") == F.col("main"), _block(F.col("outer"), F.col("inner"))).otherwise(_block(F.lit(0), F.col("outer")))
    # The largest part (blocks from `outer` on) meets the others only.
    last = F.when(F.col("part") == F.col("main"), F.col("outer") - 1).otherwise(F.col("outer") + F.col("inner") - 1)
    placed = stage(placed.select("node", "root", "part", own.alias("block"), last.alias("last")), "near-open-placed")
    rows = sets.where("blocks > 1").select("node", "members").join(placed, "node")
    pairs = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    return pairs.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                        "block", "node", "part", "members")


def near_groups(docs: DataFrame, key: str = "doc_id", width: int = 3, percent: int = 85) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs (key, text) -> (profiles, classes, groups).

    profiles: (key, n_shingles, s1, s2), one row per document; classes: (s1, s2,
    node, first), the smallest key of each distinct set; groups: (node, root)
    for linked classes only. `key` need not be unique."""
    profile = stage(_profile(docs, key, width, percent), "near-profile")
    full = profile.where("n_shingles > 0")
    classes = stage(full.groupBy("s1", "s2").agg(F.min(key).alias("first"), F.max("n_shingles").alias("n"))
                    .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    reps = stage(full.join(classes, ["s1", "s2"]).where(F.col(key).eqNullSafe(F.col("first"))).select("node", "bands"), "near-bands")
    banded = reps.select("node", F.explode("bands").alias("band"))
    hubs = stage(banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
                 .where("hub < last").select("band", "hub"), "near-hubs")
    stars = banded.join(hubs, "band").where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    clusters = components(stars, "near-clusters")

    sized = stage(clusters.join(classes, "node").select("node", "root", "s1", "s2", "first", "n"), "near-members")
    sizes = stage(sized.groupBy("root").agg(_blocks(F.count(F.lit(1)), F.sum("n")).alias("blocks")), "near-sizes")
    slot = F.pmod(F.hash("node"), F.lit(PIVOTS))
    pivots = stage(sized.groupBy("root", slot).agg(F.min("node").alias("node")).select("node", F.lit(True).alias("pivot")), "near-pivots")
    members = stage(sized.join(sizes, "root").join(pivots, "node", "left").fillna(False, ["pivot"]), "near-wanted")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tb.column_slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                values, bounds = _sets(data, offsets, width)
                full_ = np.flatnonzero(np.diff(bounds))
                if not len(full_):
                    continue
                d1, d2 = _digests(values, np.append(bounds[full_], len(values)))
                same = (tb.as_long(d1) == part.column("s1").to_numpy()[full_]) & (tb.as_long(d2) == part.column("s2").to_numpy()[full_])
                rows = full_[same]  # another text under the same key is not the class's
                took = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [took.column("root"), took.column("blocks"), took.column("pivot"), took.column("node"),
                     pa.array([values[bounds[r]:bounds[r + 1]].tobytes() for r in rows.tolist()], pa.binary())],
                    ["root", "blocks", "pivot", "node", "members"])

    wanted = members.select(F.col("first").alias("__first"), "s1", "s2", "root", "blocks", "pivot", "node")
    # Always by a shuffle: a broadcast of few members would give small inputs another plan than large ones.
    texts = docs.join(wanted.hint("merge"), docs[key].eqNullSafe(wanted["__first"])) \
        .select("root", "blocks", "pivot", "node", "s1", "s2", "text")
    sets = stage(texts.mapInArrow(fetch, "root long, blocks int, pivot boolean, node long, members binary"), "near-sets")
    block = _block(F.lit(0), F.col("blocks"))
    at = F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(block))
    pieces = sets.select("root", F.explode(at).alias("i"), block.alias("block"), "node", F.col("node").alias("part"), "members")
    links = stage(_verify(pieces.withColumn("j", F.col("i")), percent), "near-links")
    rest = stage(_verify(_open_pieces(members, sets, banded, links), percent), "near-links-rest")
    links = links.unionAll(rest)
    return profile.select(key, "n_shingles", "s1", "s2"), classes, components(links, "near-groups")


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, n_shingles, component_id, kept)."""
    profile, classes, groups = near_groups(docs.select("doc_id", "text"), "doc_id", width, percent)
    placed = stage(classes.join(groups, "node", "left").select("s1", "s2", "first", F.coalesce("root", "node").alias("root")), "near-placed")
    names = stage(placed.groupBy("root").agg(F.min("first").alias("component_id")), "near-names")
    of_class = stage(placed.join(names, "root").select("s1", "s2", "component_id"), "near-of-class")
    # An empty set belongs to no class.
    own = F.when(F.col("n_shingles") > 0, F.col("s1"))
    rows = profile.select("doc_id", "n_shingles", own.alias("s1"), "s2").join(of_class, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, one of each near-duplicate group: that of the
    smallest id (nulls last), any one of identical rows. Empty texts all stay."""
    rows = stage(docs.withColumn("__id", F.monotonically_increasing_id()), "near-rows")
    profile, classes, groups = near_groups(rows.select("__id", quoted("text").alias("text")), "__id", width, percent)
    placed = stage(classes.join(groups, "node", "left").select("s1", "s2", F.coalesce("root", "node").alias("root")), "near-placed")
    of_row = profile.where("n_shingles > 0").join(placed, ["s1", "s2"]).select("__id", "root")
    named = rows.select("__id", quoted("doc_id").alias("doc_id")).join(of_row, "__id", "left")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("__id"))
    stay = named.where("root IS NOT NULL").groupBy("root").agg(F.min(rank)["__id"].alias("__id")).select("__id")
    stay = stage(stay.unionAll(named.where("root IS NULL").select("__id")), "near-stay")
    # By a shuffle at every size, like the fetch of the texts above.
    return rows.join(stay.hint("merge"), "__id", "left_semi").drop("__id")


def op3_neardup(spark: SparkSession, data_dir: str) -> DataFrame:
    return near_duplicates(table(spark, data_dir, "documents", "doc_id", "text"))


OP3_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT rid, array_to_string(list_slice(w, i, i + 2), ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT rid, count(*) AS n FROM s GROUP BY rid
), p AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS shared FROM s a JOIN s b USING (g) WHERE a.rid != b.rid GROUP BY ALL
), e AS (
  SELECT x, y FROM p JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y WHERE 100 * shared >= 85 * (nx.n + ny.n - shared)
), r AS (
  SELECT rid, rid AS seen FROM d UNION SELECT r.rid, e.y FROM r JOIN e ON e.x = r.seen
), c AS (
  SELECT r.rid, min(d.doc_id) AS component_id FROM r JOIN d ON d.rid = r.seen GROUP BY r.rid
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept
FROM d LEFT JOIN n USING (rid) JOIN c USING (rid)
"""

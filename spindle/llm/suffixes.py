"""Suffix-array dedup: removes every byte of a 200-byte string that starts
anywhere else as well.

The index is a logarithmic family of sparse suffix arrays. A suffix is sampled
where the smallest k-gram hash of some 200-byte window stands, so equal windows
sample the same place whatever surrounds them, and about two suffixes in 178
bytes are kept instead of every one. A suffix entry is (h, d, text, place): the
hash of its first bytes, the hash of the whole stretch of windows that chose it,
and where it is. `SuffixFamily.add` sorts a batch of texts into a new run;
equal-sized levels merge into one of twice the size before the next run comes
in; `matches` merge-scans all levels by h for suffixes that start alike.

Entries that share h and d have equal stretches: all their windows repeat. The
others (the edges of a repeat) are compared window by window inside their h
group: in one bounded task per group where it has at most `GROUP` different
stretches, by a shuffle of window hashes where it has more.

Order within a run is that of the hash of the leading bytes rather than of the
bytes: only equality of long matches is asked for. Windows are compared by
128-bit hashes, texts by 80-bit digests. A fixed-size bit table thins the scan;
what it lets through by chance is dropped by the join.

Nulls and edge cases: null text counts as empty; texts under `width` bytes lose
nothing unless a longer one is repeated; identical rows remove each other's text
whole; strings are judged on the input; an empty table gives an empty result;
columns whose names clash with the result's are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import textbytes as tb
from spindle.llm.common import quoted, stage, table, without

# Fixed values.
WIDTH = 200
GRAM = 24
GROUP = 4096
FILTER_BITS = 1 << 25
CHUNK = 1 << 19
SEGMENT = 8 << 20
PLACE_BITS = 24     # of a packed hash: place within a segment
BATCHES = 2
ENTRY = "h long, d long, q long, place long"
RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def digest(text: bytes) -> tuple[int, int]:
    """80 bits of a text: a signed 64-bit number and a 16-bit one."""
    raw = hashlib.blake2b(text, digest_size=10).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little")


def _digests(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = data.tobytes()
    found = [digest(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return np.array([q for q, _ in found], np.int64), np.array([r for _, r in found], np.int64)


def _stretches(data: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Sampled suffixes of a slice: (h, d, row, lo, hi), windows lo to hi having
    chosen the same place. Row r's windows start at first[r] to last[r]."""
    none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    n = len(data) - width + 1
    if n <= 0:
        return none
    hashes = tb.mix64(tb.Ranges(data).fixed(min(GRAM, width)))
    span = width - min(GRAM, width) + 1  # k-grams of a window
    low = (hashes >> tb.U(PLACE_BITS) << tb.U(PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach * 2 <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < span:
        low = np.minimum(low[:len(low) - (span - reach)], low[span - reach:])
    at = (low & tb.U((1 << PLACE_BITS) - 1)).astype(np.int64)
    sizes = np.maximum(0, last - first + 1)
    if not sizes.sum():
        return none
    rows = np.repeat(np.arange(len(first)), sizes)
    starts = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[rows]
    place = at[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (rows[1:] != rows[:-1])
    begin = np.flatnonzero(new)
    lo, hi = starts[begin], starts[np.append(begin[1:] - 1, len(starts) - 1)]
    whole = tb.mix64(tb.Ranges(data, tb.BASES[1]).of(lo, hi + width) + (hi - lo).astype(np.uint64))
    return hashes[place[begin]], whole, rows[begin], lo, hi


def _segments(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, offset of the segment in its text, bytes, first and last
    window starts by row): a slice whole, or a huge text in overlapping parts."""
    if len(data) <= SEGMENT:
        yield 0, 0, data, offsets[:-1], offsets[1:] - width
        return
    assert len(offsets) == 2  # only a single text is larger than a slice
    for a in range(0, len(data) - width + 1, SEGMENT):
        part = data[a:a + SEGMENT + width - 1]
        yield 0, a, part, np.zeros(1, np.int64), np.array([len(part) - width])


def suffix_run(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """docs (text) -> suffix entries. place packs the first window's start, the
    number of further windows and 16 digest bits of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in tb.column_slices(batch.column("text")):
                q, q2 = _digests(data, offsets)
                for _, base, part, first, last in _segments(data, offsets, width):
                    h, d, row, lo, hi = _stretches(part, first, last, width)
                    start = lo - first[row] + base
                    place = (start << 24) | ((hi - lo) << 16) | q2[row]
                    yield pa.RecordBatch.from_arrays([pa.array(tb.as_long(h)), pa.array(tb.as_long(d)), pa.array(q[row]),
                                                      pa.array(place)], ["h", "d", "q", "place"])

    return docs.select("text").mapInArrow(run, ENTRY)


def _start(place: str = "place"):
    return F.call_function("shiftrightunsigned", F.col(place), F.lit(24))


def _further(place: str = "place"):
    return F.call_function("shiftrightunsigned", F.col(place), F.lit(16)).bitwiseAND(F.lit(255))


def _q2(place: str = "place"):
    return F.col(place).bitwiseAND(F.lit(65535))


class SuffixFamily:
    """Levels of suffix runs; level i holds up to 2**i batches."""

    def __init__(self, width: int = WIDTH, filter_bits: int = FILTER_BITS):
        self.width, self.filter_bits = width, filter_bits
        self.levels: dict[int, list[DataFrame]] = {}

    def add(self, docs: DataFrame) -> None:
        """Sort a batch of texts into a new run of the lowest level, after
        merging full levels upwards."""
        level = 0
        while len(self.levels.get(level, [])) == 2:
            one, two = self.levels.pop(level)
            merged = one.unionAll(two).repartition("h", "d").sortWithinPartitions("h", "d")
            self.levels.setdefault(level + 1, []).append(stage(merged, f"suffix-level{level + 1}"))
            level += 1
        run = suffix_run(docs, self.width).sortWithinPartitions("h", "d")
        self.levels.setdefault(0, []).append(stage(run, "suffix-run"))

    def entries(self) -> DataFrame:
        runs = [r for level in self.levels.values() for r in level]
        out = runs[0]
        for r in runs[1:]:
            out = out.unionAll(r)
        return out

    def matches(self) -> DataFrame:
        """Merge-scan of all levels: (h, d, q, place, copies) of suffixes whose h
        stands elsewhere too; copies counts identical texts."""
        entries = self.entries()
        shared = stage(entries.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "suffix-shared")
        bits = self.filter_bits
        at = F.pmod(F.col("h"), F.lit(bits))
        rows = shared.groupBy(F.floor(at / 64).cast("int").alias("w")).agg(F.bit_or(F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))).alias("b")).toArrow()  # bits / 64 rows at most
        found = np.zeros(bits // 64, dtype=np.int64)
        found[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
        table_ = entries.sparkSession.sparkContext.broadcast(found)

        def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place = batch.column("h").to_numpy() % bits
                yield batch.filter(pa.array(((table_.value[place >> 6] >> (place & 63)) & 1).astype(bool)))

        # Written before it is summed: the sum then has an exchange of its own, and the
        # join on h, which a common passage makes hot, may be split by adaptive execution.
        near = stage(entries.mapInArrow(thin, ENTRY).join(shared, "h"), "suffix-near")
        return near.groupBy("h", "d", "q", "place").agg(F.count(F.lit(1)).alias("copies"))


def _packed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """docs (columns, text) with q, q2 and the compressed bytes instead of text."""
    fields = ", ".join(f"`{c.replace('`', '``')}` {docs.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for lo, hi, data, offsets in tb.column_slices(batch.column("text")):
                q, q2 = _digests(data, offsets)
                raw = data.tobytes()
                z = [pack.compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(lo, hi - lo) for c in columns], pa.array(q), pa.array(q2),
                                                  pa.array(z, pa.binary())], [*columns, "q", "q2", "z"])

    return docs.select(*[quoted(c) for c in columns], "text").mapInArrow(run, (fields + ", " if columns else "") + "q long, q2 long, z binary")


def _edge_stretches(docs: DataFrame, edges: DataFrame, width: int) -> DataFrame:
    """(h, many, n, q, place, bytes): the bytes of the stretches in `edges`."""
    asked = stage(edges.groupBy("q", _q2().alias("q2")).agg(F.collect_list(F.struct("h", "many", "n", "place")).alias("asked")), "suffix-asked")
    texts = _packed(docs, []).groupBy("q", "q2").agg(F.first("z").alias("z")).join(asked, ["q", "q2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            asked_ = batch.column("asked")
            for r, (q, z) in enumerate(zip(batch.column("q").to_pylist(), batch.column("z").to_pylist())):
                text, own = open_.decompress(z), pa.RecordBatch.from_struct_array(asked_[r].values)
                place = own.column("place").to_numpy()
                lo, further = place >> 24, (place >> 16) & 255
                cut = [text[a:a + f + width] for a, f in zip(lo.tolist(), further.tolist())]
                yield pa.RecordBatch.from_arrays([own.column("h"), own.column("many"), own.column("n"), pa.array(np.full(len(cut), q)),
                                                  own.column("place"), pa.array(cut, pa.binary())], ["h", "many", "n", "q", "place", "bytes"])

    return texts.select("q", "z", "asked").mapInArrow(run, "h long, many boolean, n long, q long, place long, bytes binary")


def _window_hashes(stretches: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, two hashes) of every window of the given stretches."""
    data = np.frombuffer(b"".join(stretches), dtype=np.uint8)
    sizes = np.array([len(s) for s in stretches])
    first = np.cumsum(sizes) - sizes
    n = sizes - width + 1
    row = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = first[row] + start
    return row, start, tb.Ranges(data).fixed(width)[at], tb.Ranges(data, tb.BASES[1]).fixed(width)[at]


def _repeated_windows(stretches: DataFrame, width: int) -> DataFrame:
    """Within each h group: windows of single stretches (n = 1) that stand in
    another stretch or twice in their own -> (q, q2, lo, hi)."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        row, start, w1, w2 = _window_hashes([r[4] for r in rows], width)
        group = tb.mix64(np.array([r[0] for r in rows], np.int64).view(np.uint64))[row]
        weight = np.array([min(2, r[1]) for r in rows])[row]
        order = np.lexsort((w2, w1, group))
        g, a, b = group[order], w1[order], w2[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (g[1:] != g[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        run = np.cumsum(new) - 1
        total = np.bincount(run, weights=weight[order])
        hit = np.zeros(len(order), dtype=bool)
        hit[order] = total[run] > 1
        hit &= weight == 1
        r, s = row[hit], start[hit]
        if not len(r):
            return _spans([], [], [], [])
        new = np.ones(len(r), dtype=bool)
        new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:] - 1, len(r) - 1)
        place = np.array([x[3] for x in rows], np.int64)[r[begin]]
        base = place >> 24
        return _spans(np.array([x[2] for x in rows], np.int64)[r[begin]], place & 65535, base + s[begin], base + s[end])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("h", "n", "q", "place", "bytes")]):
                if size >= CHUNK and r[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[4])
        if rows:
            yield solve(rows)

    together = stretches.repartition("h").sortWithinPartitions("h")
    return together.mapInArrow(run, "q long, q2 long, lo long, hi long")


def _spans(q, q2, lo, hi) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (q, q2, lo, hi)], ["q", "q2", "lo", "hi"])


def _repeated_windows_shuffled(stretches: DataFrame, width: int) -> DataFrame:
    """The same for groups of any size, one row per window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("h", "n", "q", "place", "bytes")]))
            for i in range(0, len(rows), 1024):
                part = rows[i:i + 1024]
                row, start, w1, w2 = _window_hashes([r[4] for r in part], width)
                place = np.array([r[3] for r in part], np.int64)[row]
                yield pa.RecordBatch.from_arrays([
                    pa.array(tb.as_long(w1)), pa.array(tb.as_long(w2)), pa.array(np.array([min(2, r[1]) for r in part], np.int64)[row]),
                    pa.array(np.array([r[2] for r in part], np.int64)[row]), pa.array(place & 65535), pa.array((place >> 24) + start)],
                    ["w1", "w2", "n", "q", "q2", "lo"])

    windows = stage(stretches.mapInArrow(run, "w1 long, w2 long, n long, q long, q2 long, lo long"), "suffix-windows")
    again = stage(windows.groupBy("w1", "w2").agg(F.sum("n").alias("total")).where("total > 1").select("w1", "w2"), "suffix-again")
    return windows.where("n = 1").join(again, ["w1", "w2"]).select("q", "q2", "lo", F.col("lo").alias("hi"))


def repeated_spans(docs: DataFrame, width: int = WIDTH, batches: int = BATCHES, group: int = GROUP) -> DataFrame:
    """docs (text) -> (q, q2, spans array<(lo, hi)>): for each text with a repeat,
    the runs of window starts whose `width` bytes also start elsewhere."""
    family = SuffixFamily(width)
    for b in range(batches):
        family.add(docs.where(F.pmod(F.xxhash64("text"), F.lit(batches)) == b))
    found = stage(family.matches(), "suffix-matches")
    kinds = stage(found.groupBy("h", "d").agg(F.sum("copies").alias("n"), F.min(F.struct("q", "place")).alias("one")), "suffix-kinds")
    groups = stage(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
                   .where("kinds > 1 AND least = 1").select("h", (F.col("kinds") > group).alias("many")), "suffix-groups")
    edges = stage(kinds.join(groups, "h").select("h", "many", "n", "one.q", "one.place"), "suffix-edges")
    parts = stage(_edge_stretches(docs, edges, width), "suffix-stretches")
    few = _repeated_windows(parts.where("NOT many").select("h", "n", "q", "place", "bytes"), width)
    many = _repeated_windows_shuffled(parts.where("many").select("h", "n", "q", "place", "bytes"), width)
    whole = found.join(kinds.where("n > 1").select("h", "d"), ["h", "d"]).select(
        "q", _q2().alias("q2"), _start().alias("lo"), (_start() + _further()).alias("hi"))
    spans = whole.unionAll(few).unionAll(many)
    return stage(spans.groupBy("q", "q2").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "suffix-spans")


def cut_repeats(docs: DataFrame, text: str = "text", width: int = WIDTH, batches: int = BATCHES, keep_bytes: bool = True) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans, kept_sha256 and (with
    `keep_bytes`) kept, the remaining bytes of the text."""
    rest = without(docs, (*RESULT, text))
    body = docs.select(*rest, quoted(text).alias("text"))
    columns = [c for c in body.columns if c != "text"]
    spans = repeated_spans(body.select("text"), width, batches)
    joined = _packed(body, columns).join(spans, ["q", "q2"], "left").select(*[quoted(c) for c in columns], "z", "spans")
    fields = ", ".join(f"`{c.replace('`', '``')}` {body.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches_:
            out: list[tuple] = []
            spans_ = batch.column("spans")
            for r, z in enumerate(batch.column("z").to_pylist()):
                raw, removed, n = open_.decompress(z), 0, 0
                left = raw
                if spans_[r].is_valid:
                    own = pa.RecordBatch.from_struct_array(spans_[r].values)
                    lo, hi = tb.interval_cover(own.column("lo").to_numpy(), own.column("hi").to_numpy() + width)
                    removed, n = int((hi - lo).sum()), len(lo)
                    edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(raw)]
                    left = b"".join(raw[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))
                out.append((len(raw), removed, n, hashlib.sha256(left).hexdigest(), left if keep_bytes else None))
            cols = list(zip(*out)) if out else [[]] * 5
            own_ = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *own_], [*columns, *RESULT])

    return joined.mapInArrow(run, (fields + ", " if columns else "") + "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op1_suffixes(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = table(spark, data_dir, "documents", "doc_id", "text")
    return cut_repeats(docs, keep_bytes=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")

"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 32 bytes cuts texts into variable chunks: a
cut falls where the hash's top bits are zero, at least `LEAST` and at most `MOST`
bytes after the last one and never inside a UTF-8 character. Cuts depend on
nearby bytes only, so an insertion shifts its own chunk and the rest line up
again. Chunks are compared by a 128-bit BLAKE2b digest; the copy in the smallest
(doc_id, place) stays and every other one is removed. With a `run`, the removed
chunks that adjoin must make up that many bytes or the whole text; the query sets
none, as it would leave most lone shared chunks in every copy.

Chunks that stand alone are ruled out first: digests are counted with partial
sums, and only those seen twice go on, thinned by a bit table of fixed size and
an exact join behind it. A digest held by very many documents is a hot join key
between two exchanges, which adaptive execution may split.

Nulls and edge cases: null text counts as empty and has no chunk; null ids come
last when the copy to keep is chosen; rows with the same id and text are one
document and get the same result; a text shorter than two cuts is one chunk; a
very long text is cut whole, as one slice; an empty table gives an empty result;
only the needed columns are read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import textbytes as tb
from spindle.llm.common import quoted, stage, table
from spindle.llm.suffixes import _digests

# The hash spans 32 bytes, so no cut looks behind its own chunk.
LEAST = 32
MOST = 512
CUT_BITS = 5
RUN = 64
FILTER_BITS = 1 << 25
GEAR = (tb.mix64(np.arange(1, 257, dtype=np.uint64) * tb.U(tb.BASES[0])) >> tb.U(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of GEAR[b] << age over the last 32 bytes, mod 2**32."""
    h = GEAR[data]
    for age in (1, 2, 4, 8, 16):
        older = h[:-age] << np.uint32(age)
        h = h.copy()
        h[age:] += older
    return h


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of all chunks of a slice, in order."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    ends = np.flatnonzero(gear_hashes(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = (data & 0xC0) == 0x80  # the next byte continues a character
    ends = ends[~inside[ends]].tolist()
    rows, out = [], []
    for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        i = 0 if not out else bisect_left(ends, a)
        start = a
        while start < b:
            i = bisect_left(ends, start + LEAST, i)
            end = ends[i] if i < len(ends) else b
            if end > start + MOST:
                end = start + MOST
                while end > start + 1 and end < b and inside[end]:
                    end -= 1
            end = min(end, b)
            if b - end < LEAST:  # a short rest belongs to the last chunk
                end = b
            rows.append(r)
            out.append(end)
            start = end
    ends_ = np.array(out, np.int64)
    row = np.array(rows, np.int64)
    starts = np.concatenate([[0], ends_[:-1]])
    new = np.ones(len(row), dtype=bool)
    new[1:] = row[1:] != row[:-1]
    starts[new] = offsets[row[new]]
    return row, starts, ends_


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of each chunk's BLAKE2b digest of 128 bits."""
    raw = data.tobytes()
    digests = b"".join([blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())])
    halves = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)
    return np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])


def _chunk_rows(docs: DataFrame, kept: tuple | None = None) -> DataFrame:
    """(k1, k2) of every chunk; with a bit table, only chunks that pass it, with
    (doc_id, q, lo, hi)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tb.column_slices(batch.column("text")):
                row, starts, ends = cuts(data, offsets)
                k1, k2 = _keys(data, starts, ends)
                if kept is None:
                    yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2)], ["k1", "k2"])
                    continue
                bits = kept[0].value
                at = k1 % (len(bits) * 64)
                hit = np.flatnonzero((bits[at >> 6] >> (at & 63)) & 1)
                q, _ = _digests(data, offsets)
                ids = batch.column("doc_id").slice(lo, hi - lo)
                first = offsets[row[hit]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[hit]), pa.array(k2[hit]), ids.take(pa.array(row[hit])), pa.array(q[row[hit]]),
                     pa.array(starts[hit] - first), pa.array(ends[hit] - first)], ["k1", "k2", "doc_id", "q", "lo", "hi"])

    if kept is None:
        return docs.select("text").mapInArrow(run, "k1 long, k2 long")
    return docs.select("doc_id", "text").mapInArrow(run, f"k1 long, k2 long, doc_id {kind}, q long, lo long, hi long")


def _sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, q, n_bytes, n_chunks), one row per input row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tb.column_slices(batch.column("text")):
                row, _, _ = cuts(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(_digests(data, offsets)[0]), pa.array(np.diff(offsets)),
                     pa.array(np.bincount(row, minlength=hi - lo).astype(np.int64))], ["doc_id", "q", "n_bytes", "n_chunks"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, q long, n_bytes long, n_chunks long")


def chunk_repeats(docs: DataFrame, run: int = RUN, filter_bits: int = FILTER_BITS) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, n_bytes, n_chunks, n_shared, n_removed,
    removed_bytes, removed array<(lo, hi)>, first_ids array): how many chunks
    stand elsewhere too, the removed runs of chunks, as byte spans of the text,
    and the documents that keep their copies."""
    shared = stage(_chunk_rows(docs).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k1", "k2"), "chunk-shared")
    at = F.pmod(F.col("k1"), F.lit(filter_bits))
    rows = shared.groupBy(F.floor(at / 64).cast("int").alias("w")).agg(F.bit_or(F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))).alias("b")).toArrow()  # filter_bits / 64 rows at most
    bits = np.zeros(filter_bits // 64, dtype=np.int64)
    bits[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    table_ = (docs.sparkSession.sparkContext.broadcast(bits),)

    found = stage(_chunk_rows(docs, table_).join(shared, ["k1", "k2"]), "chunk-found")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("first_id"), F.col("q").alias("first_q"), F.col("lo").alias("first_lo"))
    first = stage(found.groupBy("k1", "k2").agg(F.min(rank).alias("f")).select("k1", "k2", "f.first_id", "f.first_q", "f.first_lo"), "chunk-first")
    placed = found.distinct().join(first, ["k1", "k2"])  # rows with the same id and text are one document
    stays = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("q") == F.col("first_q")) & (F.col("lo") == F.col("first_lo"))
    gone = F.when(~stays, F.struct("lo", "hi", "first_id"))
    per_doc = stage(placed.groupBy("doc_id", "q").agg(F.count(F.lit(1)).alias("n_shared"), F.sort_array(F.collect_list(gone)).alias("gone")), "chunk-docs")
    own = per_doc.withColumnRenamed("doc_id", "__id").withColumnRenamed("q", "__q")
    sizes = _sizes(docs)
    joined = sizes.join(own, sizes["doc_id"].eqNullSafe(own["__id"]) & (sizes["q"] == own["__q"]), "left")
    chunk = per_doc.schema["gone"].dataType
    joined = joined.withColumn("gone", F.coalesce("gone", F.array().cast(chunk)))
    # The chunks of a run share its start: the end of the last gap before them.
    run_start = F.transform("gone", lambda g, i: F.when(F.coalesce(F.get("gone", i - 1)["hi"] == g["lo"], F.lit(False)), F.lit(None)).otherwise(g["lo"]))
    joined = joined.withColumn("__starts", F.filter(run_start, lambda x: x.isNotNull()))
    run_end = F.transform("gone", lambda g, i: F.when(F.coalesce(F.get("gone", i + 1)["lo"] == g["hi"], F.lit(False)), F.lit(None)).otherwise(g["hi"]))
    joined = joined.withColumn("__ends", F.filter(run_end, lambda x: x.isNotNull()))
    runs = F.filter(F.zip_with("__starts", "__ends", lambda a, b: F.struct(a.alias("lo"), b.alias("hi"))),
                    lambda r: (r["hi"] - r["lo"] >= run) | (r["hi"] - r["lo"] == F.col("n_bytes")))
    joined = joined.withColumn("removed", runs)
    inside = F.filter("gone", lambda g: F.exists("removed", lambda r: (g["lo"] >= r["lo"]) & (g["hi"] <= r["hi"])))
    long_ = lambda x: F.lit(x).cast("long")
    return joined.select(
        "doc_id", "n_bytes", "n_chunks", F.coalesce("n_shared", long_(0)).alias("n_shared"), F.size("removed").cast("long").alias("n_removed"),
        F.aggregate("removed", long_(0), lambda acc, r: acc + r["hi"] - r["lo"]).alias("removed_bytes"), "removed",
        F.sort_array(F.array_distinct(F.transform(inside, lambda g: g["first_id"]))).alias("first_ids"))


def remove_spans(docs: DataFrame, spans: str = "removed", text: str = "text") -> DataFrame:
    """`docs` with the byte spans of column `spans` cut from the text (a null
    text, or one without spans, stays as it is)."""
    fields = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, gone in zip(batch.column(text).to_pylist(), batch.column(spans).to_pylist()):
                if body and gone:
                    raw, at, left = body.encode(), 0, []
                    for g in sorted(gone, key=lambda g: g["lo"]):
                        left.append(raw[at:g["lo"]])
                        at = max(at, g["hi"])
                    body = b"".join([*left, raw[at:]]).decode()
                out.append(body)
            i = batch.schema.get_field_index(text)
            yield batch.set_column(i, batch.schema.field(i), pa.array(out, batch.schema.field(i).type))

    return docs.select(*[quoted(c) for c in docs.columns]).mapInArrow(run, fields)


def op10_chunks(spark: SparkSession, data_dir: str) -> DataFrame:
    return chunk_repeats(table(spark, data_dir, "documents", "doc_id", "text"), run=0)

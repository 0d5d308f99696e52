"""Packing documents into training sequences by minimum bin slack.

A document is its token ids and one closing id. Whole windows are cut off its
front; what remains, shorter than a window, goes to the packer. The packer knows
the remaining pieces by their counts per length. For each window it sets the
longest piece, then a bitset subset-sum over the counts (a bit per reachable
length, binary multiples of each length) finds the multiset that comes closest to
the room left, and walks back through the bitsets for its counts. A multiset is
used as often as the counts allow.

Where the closest multiset still leaves slack, every piece that is left is longer
than the slack, so the longest one is cut to fill it and its rest returns to the
counts. The last window of a block has nothing to be cut from: it ends as
sequences whose lengths are powers of two, which need no padding. So no sequence
is padded, and the documents cut without need are counted in the tests.

Spark deals the documents out; each task packs blocks of up to `BLOCK_TOKENS`
remaining tokens in the order of its rows. Nothing is shuffled or collected, a
task holds one block, and a lost task is packed again alike, as a file is read
in the same order. A sequence belongs to one block, so its id is the number of
the task and a running number.

Ids: the contract defines them by the `tokenizers` file; tiktoken with the rank
file of the same vocabulary gives the same ids four times as fast (the tests
compare both over every code point). Strings of special tokens in a text are
ordinary text. Long texts are encoded in stretches that end before a space
between two letters, where no token can cross.

Nulls and edge cases: null text is empty, so such a document is the closing id
alone; null keys are carried; repeated rows are packed each; very long texts
become whole windows and one rest; ties between pieces of a length go by row
order; an empty table gives an empty result; only the key columns of the input
are carried, so no other column can clash.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import quoted, table

# Fixed values.
WINDOW = 1024
CLOSING_ID = 0
RANKS = "byte_bpe_50k.tiktoken"
BLOCK_TOKENS = 1 << 22
STRETCH = 1 << 18     # characters encoded at once
EMIT_TOKENS = 1 << 20
BETWEEN_WORDS = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (one base64 token and its id a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoder(ranks: dict[bytes, int], pattern: str):
    """Text -> ids as numpy unsigned 32-bit numbers, with the closing id."""
    import tiktoken

    coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    closing = np.array([CLOSING_ID], dtype="<u4")

    def encode(text: str) -> np.ndarray:
        parts, at = [], 0
        while len(text) - at > STRETCH:
            cut = BETWEEN_WORDS.search(text, at + STRETCH)
            if cut is None:
                break
            parts.append(coder.encode_to_numpy(text[at:cut.start()], disallowed_special=()))
            at = cut.start()
        parts.append(coder.encode_to_numpy(text[at:] if at else text, disallowed_special=()))
        return np.concatenate([*parts, closing]).astype("<u4", copy=False)

    return encode


def fill(counts: np.ndarray, room: int) -> tuple[int, dict[int, int]]:
    """The multiset of at most counts[l] pieces of each length l whose sum comes
    closest to `room` from below: (its sum, its counts)."""
    reach, layers, mask = 1, [], (1 << (room + 1)) - 1
    for length in np.flatnonzero(counts[:room + 1])[::-1].tolist():
        left, step = min(int(counts[length]), room // length), 1
        while left:
            take = min(step, left)
            layers.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, step = left - take, step * 2
        if reach >> room:
            break
    best = at = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(layers):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= length * take
    return best, chosen


def pack_lengths(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, int]:
    """Pack pieces of the given lengths (all below `window`). Returns rows of
    (piece, start in the piece, length, sequence, offset) and the number of
    sequences."""
    counts = np.bincount(lengths, minlength=window + 1)
    pool: dict[int, list[tuple[int, int]]] = {}
    for piece, length in enumerate(lengths.tolist()):
        pool.setdefault(length, []).append((piece, 0))
    out: list[tuple[int, int, int, int, int]] = []
    sequence, longest = 0, window

    def take(length: int, n: int) -> list[tuple[int, int]]:
        taken = pool[length][-n:]
        del pool[length][-n:]
        counts[length] -= n
        return taken

    while True:
        present = np.flatnonzero(counts[:longest + 1])
        if not len(present):
            return np.array(out, dtype=np.int64).reshape(-1, 5), sequence
        longest = int(present[-1])
        counts[longest] -= 1
        best, chosen = fill(counts, window - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        slack, need, cut = window - longest - best, dict(chosen), 0
        if slack:
            spare = counts[:longest + 1].copy()
            for length, n in chosen.items():
                spare[length] -= n
            left = np.flatnonzero(spare)
            if not len(left):  # the last window
                sequence = _last(chosen, take, window - slack, sequence, out)
                continue
            cut = int(left[-1])
            need[cut] = need.get(cut, 0) + 1
        times = min(int(counts[length]) // n for length, n in need.items())
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            for i, (piece, start) in enumerate(take(length, n * times)):
                out.append((piece, start, length, sequence + i // n, offset + i % n * length))
            offset += n * length
        if cut:
            for i, (piece, start) in enumerate(take(cut, times)):
                out.append((piece, start, slack, sequence + i, offset))
                pool.setdefault(cut - slack, []).append((piece, start + slack))
            counts[cut - slack] += times
        sequence += times


def _last(chosen: dict[int, int], take, total: int, sequence: int, out: list) -> int:
    """Lay the last pieces of a block over sequences of falling powers of two."""
    room = offset = 0
    for length in sorted(chosen, reverse=True):
        for piece, start in take(length, chosen[length]):
            left = length
            while left:
                if not room:
                    room, offset = 1 << (total.bit_length() - 1), 0
                    total -= room
                    sequence += 1
                part = min(left, room)
                out.append((piece, start, part, sequence - 1, offset))
                start, left, offset, room = start + part, left - part, offset + part, room - part
    return sequence


class _Block:
    """The remaining pieces of a block of documents, and its keys."""

    def __init__(self):
        self.keys: list[list[pa.Array]] = []
        self.rests: list[np.ndarray] = []
        self.sizes: list[int] = []  # tokens of each document
        self.tokens = 0

    def add(self, keys: list[pa.Array], ids: np.ndarray) -> None:
        rest = ids[len(ids) // WINDOW * WINDOW:].copy()
        self.keys.append(keys)
        self.rests.append(rest)
        self.sizes.append(len(ids))
        self.tokens += len(rest)


def _batch(keys: list[pa.Array], rows: np.ndarray, ids: np.ndarray, bounds: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Result rows (start, length, document tokens, sequence, offset) with their
    keys; row i holds the ids from bounds[i] to bounds[i + 1]."""
    binary = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids)])
    start, length, size, sequence, offset = (pa.array(rows[:, i]) for i in range(5))
    return pa.RecordBatch.from_arrays([*keys, start, length, binary, size, sequence, offset], names)


def pack(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", ranks_file: str | None = None,
         pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """One row per piece: the keys of its document, start (the document's ids
    before it), length, ids (binary: little-endian unsigned 32-bit numbers),
    doc_tokens, sequence_id and offset (its place in the sequence)."""
    body = docs.select(*[quoted(k) for k in keys], quoted(text).alias("__text"))
    names = [*keys, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    fields = [f"`{k.replace('`', '``')}` {docs.schema[k].dataType.simpleString()}" for k in keys]
    schema = ", ".join([*fields, "start long", "length long", "ids binary", "doc_tokens long", "sequence_id long", "offset long"])
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_file or public_tokenizers.path(RANKS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value, pattern)
        sequence = TaskContext.get().partitionId() << 32

        def windows(rows: list[tuple[list[pa.Array], np.ndarray]]) -> pa.RecordBatch:
            """The whole windows of some documents, a sequence each."""
            nonlocal sequence
            n = np.array([len(ids) // WINDOW for _, ids in rows])
            total = int(n.sum())
            start = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
            made = np.stack([start * WINDOW, np.full(total, WINDOW), np.repeat([len(ids) for _, ids in rows], n),
                             sequence + np.arange(total), np.zeros(total, np.int64)], axis=1)
            sequence += total
            which = pa.array(np.repeat(np.arange(len(rows)), n))
            held = [pa.concat_arrays([key[i] for key, _ in rows]).take(which) for i in range(len(keys))]
            ids = np.concatenate([ids[:len(ids) // WINDOW * WINDOW] for _, ids in rows])
            return _batch(held, made, ids, np.arange(total + 1) * WINDOW, names)

        def rests(block: _Block) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            lengths = np.array([len(r) for r in block.rests], dtype=np.int64)
            own = np.flatnonzero(lengths)
            pieces, used = pack_lengths(lengths[own])
            held = [pa.concat_arrays([k[i] for k in block.keys]) for i in range(len(keys))]
            sizes = np.array(block.sizes, dtype=np.int64)
            bounds = np.concatenate([[0], np.cumsum(pieces[:, 2])])
            lo = 0
            while lo < len(pieces):
                hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + EMIT_TOKENS, side="right")) - 1)
                part = pieces[lo:hi]
                at = own[part[:, 0]]
                ids = np.concatenate([block.rests[d][s:s + n] for d, s, n in zip(at.tolist(), part[:, 1].tolist(), part[:, 2].tolist())])
                made = np.stack([sizes[at] // WINDOW * WINDOW + part[:, 1], part[:, 2], sizes[at], sequence + part[:, 3], part[:, 4]], axis=1)
                yield _batch([h.take(pa.array(at)) for h in held], made, ids, bounds[lo:hi + 1] - bounds[lo], names)
                lo = hi
            sequence += used

        block, whole, waiting = _Block(), [], 0
        for batch in batches:
            texts = pc.fill_null(batch.column(len(keys)), "")
            every = pa.array(np.arange(batch.num_rows))
            copied = [batch.column(i).take(every) for i in range(len(keys))]  # a copy does not hold the texts
            for row in range(batch.num_rows):
                ids = encode(texts[row].as_py())
                key = [c.slice(row, 1) for c in copied]
                block.add(key, ids)
                if len(ids) >= WINDOW:
                    whole.append((key, ids))
                    waiting += len(ids)
                    if waiting >= EMIT_TOKENS:
                        yield windows(whole)
                        whole, waiting = [], 0
                if block.tokens >= BLOCK_TOKENS:
                    yield from rests(block)
                    block = _Block()
            if whole:
                yield windows(whole)
                whole, waiting = [], 0
        if block.sizes:
            yield from rests(block)

    return body.mapInArrow(run, schema)


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """(sequence_id, length, ids) from the pieces of `pack`: the ids in order of
    offset, padded with the closing id to `window` unless the length is a power of
    two. A group has at most `window` pieces."""
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.aggregate("p", F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"]))
    is_power = F.expr("length & (length - 1)") == 0
    size = F.when(is_power, F.col("length")).otherwise(F.lit(window)).cast("int") * 4
    pad = F.lit(CLOSING_ID.to_bytes(4, "little") * window).cast("binary")
    return rows.select("sequence_id", "length", F.substring(F.concat(ids, pad), F.lit(1), size).alias("ids"))


def op11_packing(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = table(spark, data_dir, "documents", "doc_id", "text")
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

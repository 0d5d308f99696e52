"""Packing: subset sums against all subsets, windows that cover every id once, ids
equal to those of the vocabulary's own library."""

import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spindle.llm import packing
from tests.llm.conftest import documents, duck, write


@given(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(0, 25))
@settings(max_examples=200, deadline=None)
def test_fill_is_the_closest_multiset(counts, room):
    have = np.array([0, *counts])
    best, chosen = packing.fill(np.concatenate([have, np.zeros(30, dtype=np.int64)]), room)
    sums = [sum(n * length for length, n in enumerate(pick, 1)) for pick in product(*[range(c + 1) for c in counts])]
    assert best == max(s for s in sums if s <= room)
    assert sum(length * n for length, n in chosen.items()) == best
    assert all(0 < n <= have[length] for length, n in chosen.items())


def checked(lengths, window=1024):
    """Every piece is covered once, every sequence is gapless and needs no padding;
    returns the sequences and the pieces that were cut."""
    rows, n = packing.pack_lengths(np.array(lengths, dtype=np.int64), window)
    inside, covered = defaultdict(list), defaultdict(list)
    for piece, start, length, sequence, offset in rows.tolist():
        inside[sequence].append((offset, length))
        covered[piece].append((start, length))
    assert sorted(inside) == list(range(n))
    for spans, total in [(s, None) for s in inside.values()] + [(covered[i], x) for i, x in enumerate(lengths)]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == total if total is not None else at == window or at & (at - 1) == 0
    return n, sum(len(c) > 1 for c in covered.values())


@given(st.lists(st.integers(1, 63), max_size=80))
@settings(max_examples=200, deadline=None)
def test_pieces_of_any_lengths(lengths):
    checked(lengths, 64)


def test_few_pieces_are_cut():
    """Pieces that fit together are left whole: those at the front of many sizes
    are cut only when nothing is left that fits their slack."""
    r = np.random.default_rng(3)
    n, cut = checked(r.integers(1, 300, 4000).tolist())
    assert cut <= 3 and n <= -(-4000 * 150 // 1024) * 1.05 + 10
    assert checked([512] * 1000) == (500, 0)
    assert checked([700, 324] * 500)[1] == 0


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_query_covers_every_id(spark, cases, tokenizer):
    rows = packing.op11_packing(spark, cases).collect()
    texts = duck(cases).execute("SELECT doc_id, text FROM documents").fetchall()
    want = sorted((i, len(tokenizer(t))) for i, t in texts if i is not None and i not in (1, 9))
    got = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        got[r.doc_id].append(r)
    assert sorted((i, p[0].doc_tokens) for i, p in got.items() if i is not None and i not in (1, 9)) == want
    for i, text in texts:
        if i is None or i in (1, 9):
            continue
        ids, at = tokenizer(text), 0
        for r in sorted(got[i], key=lambda r: r.start):
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert sum(r.length for r in rows) == sum(len(tokenizer(t)) for _, t in texts)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0


def test_long_texts_and_special_strings(tokenizer):
    encode = packing.encoder(packing.read_ranks(public_tokenizers.path(packing.RANKS)), public_tokenizers.PATTERN)
    long = " ".join(t or "" for _, t, _ in documents()) * 6
    assert len(long) > packing.STRETCH
    for text in ("", "<|endoftext|> a <|endoftext|>", long, "x" * 300_000, " \n" * 200_000, "l'été 12 's    x"):
        assert encode(text).tolist() == tokenizer(text)


def test_ids_agree_on_every_code_point(tokenizer):
    encode = packing.encoder(packing.read_ranks(public_tokenizers.path(packing.RANKS)), public_tokenizers.PATTERN)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for lo in range(0, len(points), 8192):
        text = "".join(f"a{c}1{c} {c} {c}{c}x" for c in points[lo:lo + 8192:3])
        assert encode(text).tolist() == tokenizer(text)


def test_sequences_are_padded(spark, tmp_path):
    path = write(tmp_path, [(i, "word " * (37 * i), "a") for i in range(1, 40)])
    pieces = packing.pack(spark.read.parquet(f"{path}/documents.parquet"))
    rows = packing.sequences(pieces).collect()
    assert all(len(r.ids) // 4 in ({1024} if r.length & (r.length - 1) else {r.length}) for r in rows)
    by = defaultdict(bytes)
    for p in sorted(pieces.collect(), key=lambda p: p.offset):
        by[p.sequence_id] += p.ids
    assert {r.sequence_id: bytes(r.ids[:4 * r.length]) for r in rows} == dict(by)

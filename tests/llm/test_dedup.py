"""Suffix, chunk and near-duplicate operators against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from spindle.llm import chunks, neardup, suffixes
from spindle.llm import textbytes as tb
from tests.llm.conftest import documents, prose, write


def removed_by_definition(texts, width):
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[s:s + width] for b in raw for s in range(len(b) - width + 1))
    out = []
    for b in raw:
        spans = []
        for s in range(len(b) - width + 1):
            if count[b[s:s + width]] > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + width
                else:
                    spans.append([s, s + width])
        left, at = b"", 0
        for a, e in spans:
            left, at = left + b[at:a], e
        left += b[at:]
        out.append((len(b), sum(e - a for a, e in spans), len(spans), hashlib.sha256(left).hexdigest()))
    return out


def run_suffixes(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, (_, t, _) in enumerate(rows)], "i long, text string, n_bytes string")
    got = suffixes.cut_repeats(df, **kw).collect()
    assert len(got) == len(rows)
    return [tuple(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in sorted(got, key=lambda r: r.i)]


def test_suffixes_equal_definition(spark):
    rows = documents()
    assert run_suffixes(spark, rows) == removed_by_definition([t for _, t, _ in rows], 200)


def test_suffixes_large_groups_and_batches(spark):
    """Every edge group through the shuffled windows, levels merged, width 50."""
    rows = [(i, prose(1, 40 + i) + prose(50 + i, 5) + prose(1, 60), "s") for i in range(8)] + [(9, "ab" * 300, "s")]
    want = removed_by_definition([t for _, t, _ in rows], 50)
    assert run_suffixes(spark, rows, width=50, batches=4) == want
    df = spark.createDataFrame([(t,) for _, t, _ in rows], "text string")
    few = suffixes.repeated_spans(df, 50, 1, 10_000).collect()
    many = suffixes.repeated_spans(df, 50, 1, 0).collect()

    def cover(spans):
        return {r.q: sorted({x for s in r.spans for x in range(s.lo, s.hi + 1)}) for r in spans}

    assert cover(few) == cover(many)


def test_huge_texts_are_cut_into_segments(monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 1000)
    data = np.frombuffer(prose(3, 900).encode(), dtype=np.uint8)
    starts = []
    for _, base, part, first, last in suffixes._segments(data, np.array([0, len(data)]), 200):
        _, _, row, lo, hi = suffixes._stretches(part, first, last, 200)
        starts += [base + s for a, b in zip(lo, hi) for s in range(a, b + 1)]
    assert starts == list(range(len(data) - 199))


def test_chunks_equal_definition(spark):
    rows = [r for r in documents() if r[0] is not None]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    got = {(r.doc_id, r.n_bytes): r for r in chunks.chunk_repeats(df).collect()}
    docs = sorted({(i, t or "") for i, t, _ in rows}, key=lambda r: (r[0], chunks._digests(np.frombuffer(r[1].encode(), np.uint8), np.array([0, len(r[1].encode())]))[0][0]))
    first, seen, parts = {}, Counter(), {}
    copies = Counter((i, t or "") for i, t, _ in rows)
    for i, t in docs:
        raw = t.encode()
        _, lo, hi = chunks.cuts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert b"".join(raw[a:b] for a, b in zip(lo, hi)) == raw
        assert all(raw[a:b].decode() is not None for a, b in zip(lo, hi))
        parts[i, t] = [(a, b, raw[a:b]) for a, b in zip(lo.tolist(), hi.tolist())]
        for a, _, c in parts[i, t]:
            first.setdefault(c, (i, t, a))
            seen[c] += copies[i, t]
    for (i, t), own in parts.items():
        runs = []
        for a, b, c in own:
            if first[c] != (i, t, a):
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
        size = len(t.encode())
        r = got[i, size]
        assert [[s.lo, s.hi] for s in r.removed] == [x for x in runs if x[1] - x[0] >= chunks.RUN or x[1] - x[0] == size]
        assert r.n_shared == sum(seen[c] > 1 for _, _, c in own)
        assert r.n_chunks == len(own)


def test_chunk_keys_are_digests():
    """A polynomial modulo 2**64 is blind to some differences; a digest is not."""
    data = np.frombuffer(prose(6, 60).encode(), dtype=np.uint8)
    starts, ends = np.array([0, 40, 40]), np.array([40, 90, 90])
    k1, k2 = chunks._keys(data, starts, ends)
    for i, (a, b) in enumerate(zip(starts, ends)):
        raw = hashlib.blake2b(data[a:b].tobytes(), digest_size=16).digest()
        assert raw == int(k1[i]).to_bytes(8, "little", signed=True) + int(k2[i]).to_bytes(8, "little", signed=True)
    assert [len(k) for k in chunks._keys(data, starts[:0], ends[:0])] == [0, 0]


def test_chunks_query_removes_lone_chunks(spark, tmp_path):
    rows = [(100 * k + i, prose(300 + 100 * k + i, 40) + prose(700 + i, 25) + prose(500 + 100 * k + i, 40), "a") for k in (0, 1) for i in range(40)]
    seen, want, lone = set(), {}, 0
    for i, text, _ in rows:
        raw = text.encode()
        _, lo, hi = chunks.cuts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        runs = []
        for a, b in zip(lo.tolist(), hi.tolist()):
            if raw[a:b] in seen:
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
            seen.add(raw[a:b])
        want[i] = runs
        lone += sum(b - a < chunks.RUN for a, b in runs)
    assert lone > 0
    got = {r.doc_id: [[s.lo, s.hi] for s in r.removed] for r in chunks.op10_chunks(spark, write(tmp_path, rows)).collect()}
    assert got == want


def test_chunks_resist_insertions(spark):
    passage = prose(77, 120)
    df = spark.createDataFrame([(1, prose(1, 50) + passage + prose(2, 50)), (2, prose(3, 33) + passage + prose(4, 20))], "doc_id long, text string")
    two = {r.doc_id: r for r in chunks.chunk_repeats(df).collect()}[2]
    assert two.removed_bytes > len(passage.encode()) // 2 and two.first_ids == [1]
    left = chunks.remove_spans(df.join(chunks.chunk_repeats(df).select("doc_id", "removed"), "doc_id")).collect()
    assert len({r.doc_id: r for r in left}[2].text.encode()) == two.n_bytes - two.removed_bytes


def groups_by_definition(texts, width, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for t in texts:
        w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in (t or "").translate(low)).split(" ") if x]
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [len(s) for s in sets], [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_groups_equal_definition(spark, width, percent, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 4)  # several blocks per cluster
    base = prose(1, 150).split(" ")
    texts = [" ".join(w if (i * 7919 + k * 31) % 101 >= k else f"w{k}" for i, w in enumerate(base)) for k in range(0, 30, 2)]
    texts += [None, "", "a b", "A b", "a", "a b c d e f", prose(9, 400), prose(9, 400) + " more"]
    sizes, roots = groups_by_definition(texts, width, percent)
    rows = neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), width, percent).collect()
    got = {r.doc_id: r for r in rows}
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == roots
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_bayes_bounds_grow_and_keep_true_pairs():
    checks = neardup.least_matches(85, 210)
    assert [m for _, m in checks] == sorted(m for _, m in checks)
    assert all(m < 0.85 * n for n, m in checks)


def test_keep_one_keeps_one_of_repeated_rows(spark):
    t = prose(5, 90)
    df = spark.createDataFrame([(1, t, "x"), (1, t, "x"), (2, t, "y"), (None, t, "z"), (3, None, "n"), (4, "", "e"), (None, prose(6, 90), "w")],
                               "doc_id long, text string, component_id string")
    rows = [tuple(r) for r in neardup.keep_one(df).collect()]
    assert sorted(r[2] for r in rows) == ["e", "n", "w", "x"]


def test_range_hashes_do_not_depend_on_place():
    data = np.frombuffer(b"xxhello--hello!", dtype=np.uint8)
    h = tb.Ranges(data).of(np.array([2, 9]), np.array([7, 14]))
    assert h[0] == h[1]


def _piece_rows(spark, monkeypatch, texts):
    counts, verify = [], neardup._verify

    def counting(pieces, percent):
        counts.append(pieces.count())
        return verify(pieces, percent)

    monkeypatch.setattr(neardup, "_verify", counting)
    rows = neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    monkeypatch.setattr(neardup, "_verify", verify)
    return counts, {r.doc_id: r.component_id for r in rows}


def test_rows_of_near_copies_grow_with_the_group(spark, monkeypatch):
    """One large group of near copies: members and pivots, no pairs of blocks."""
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 16)
    base = [f"b{i}" for i in range(120)]
    rows = {}
    for n in (200, 400):
        counts, groups = _piece_rows(spark, monkeypatch, [" ".join([*base[:i % 120], f"w{i}", *base[i % 120 + 1:]]) for i in range(n)])
        rows[n] = sum(counts)
        assert set(groups.values()) == {0}
    assert rows[400] <= 2.2 * rows[200] and rows[400] <= 400 * (1 + 2 * neardup.PIVOTS / 16)


def test_candidates_that_stay_apart_still_meet(spark, monkeypatch):
    """Chains, whose ends are no links, and groups next to each other in one cluster."""
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 2)
    monkeypatch.setattr(neardup, "PIVOTS", 1)
    base = [f"b{i}" for i in range(100)]
    texts = [" ".join([f"c{j}" if j < 3 * i else w for j, w in enumerate(base)]) for i in range(12)]
    texts += [" ".join([f"d{j}" if j < 9 else w for j, w in enumerate(base)]) + " end" * k for k in range(4)]
    words = [t.split() for t in texts]
    sets = [{tuple(w[i:i + 3]) for i in range(len(w) - 2)} for w in words]
    label = list(range(len(texts)))
    for _ in texts:
        for x in range(len(texts)):
            for y in range(len(texts)):
                if 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y]):
                    label[x] = min(label[x], label[y])
    counts, groups = _piece_rows(spark, monkeypatch, texts)
    assert groups == dict(enumerate(label)) and counts[1] > 0

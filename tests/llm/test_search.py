"""Search: the graph of shared sums against plain sums, blocks of items, ties."""

import random

import numpy as np
import pyarrow as pa

from spindle.llm import search
from tests.llm.conftest import write


def items_of(seed: int, n: int, terms: int, longest: int) -> list[dict[int, int]]:
    r = random.Random(seed)
    common = list(range(12))
    return [{t: r.randint(1, 3) for t in r.sample(common, r.randint(0, 9)) + r.sample(range(terms), r.randint(0, longest))} for _ in range(n)]


def test_graph_sums_equal_plain_sums():
    for seed in range(6):
        items = items_of(seed, 40, 300, 20 if seed else 200)
        graph = search.mine(items)
        r = np.random.default_rng(seed)
        value = r.integers(0, 10 ** 12, (300, 7))
        acc = np.zeros((graph.nodes, 7), dtype=np.int64)
        acc[:len(graph.leaf_term)] = value[graph.leaf_term] * graph.leaf_repeats[:, None]
        graph.evaluate(acc)
        for i, item in enumerate(items):
            want = sum((value[t] * n for t, n in item.items()), np.zeros(7, dtype=np.int64))
            assert (graph.roots[i] < 0) == (not item)
            if item:
                assert (acc[graph.roots[i]] == want).all()


def test_shared_sets_are_added_once():
    """Items that hold the same pairs and sets: far fewer additions than item by item."""
    r = random.Random(1)
    groups = [[10 * g + i for i in range(6)] for g in range(8)]
    items = [{t: 1 for g in r.sample(groups, 4) for t in g} for _ in range(60)]
    graph = search.mine(items)
    assert graph.additions < sum(len(i) - 1 for i in items) / 5
    assert len(graph.levels) >= 3  # sums of sums


def test_best_keeps_ties_by_id():
    best = search._Best(1, 2)
    for ids in ([9, 4], [7, 1], [2, 3]):
        best.add(np.array([[5, 5]]), np.array(ids), np.array([False, ids[0] == 2]))
        best.prune()
    item, score, missing, ids = best.prune()
    assert ids.tolist() == [1, 2] and score.tolist() == [5, 5]


def test_terms():
    assert search.count_terms("Don't x-ray ÉTÉ été 日本 don A1_b2") == {
        b"don": 2, b"t": 1, b"x": 1, b"ray": 1, "ÉtÉ".encode(): 1, "été".encode(): 1, "日本".encode(): 1, b"a1": 1, b"b2": 1}
    assert search.count_terms(None) == search.count_terms("- _ \x00") == {}
    long = "ab cd! " * 400_000
    assert search.count_terms(long) == {b"ab": 400_000, b"cd": 400_000}


def test_blocks_of_items_give_the_same(spark, cases, monkeypatch):
    want = sorted(search.op12_search(spark, cases).collect(), key=str)
    monkeypatch.setattr(search, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(search, "CELLS", 200)
    assert sorted(search.op12_search(spark, cases).collect(), key=str) == want


def test_every_term_in_every_document(spark, tmp_path):
    """A weight may be 0; such documents are not ranked."""
    path = write(tmp_path, [(i, "the same text", "a") for i in range(30)], [(1, "the"), (2, "text other")])
    rows = search.op12_search(spark, path).collect()
    assert sorted((r.item_id, r.rank, r.doc_id) for r in rows) == [(i, k + 1, k) for i in (1, 2) for k in range(10)]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert search.search(spark.read.parquet(f"{path}/documents.parquet"), empty).count() == 0
    assert pa.types.is_int64(search.op12_search(spark, path).toArrow().schema.field("score").type)

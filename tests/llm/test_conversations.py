"""Conversation repair: every edit sequence tried on short conversations, blocks and
levels of any size, memory that does not follow a conversation."""

import hashlib
import random
import re
from itertools import product

from spindle.llm import conversations as cv
from tests.llm.conftest import duck

GOAL = re.compile(r"(s?(ua)+)?\Z")


def every_repair(rows):
    """(cost, audit) of the best of all edits of rows (initial, must go, truncated),
    with up to two inserts at each gap."""
    best = None
    for inserts in product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
        if sum(map(len, inserts)) > len(rows) + 2:
            continue
        for edits in product("KuaD", repeat=len(rows)):
            shape, cost, audit = inserts[0], 3 * len("".join(inserts)), "I" * len(inserts[0])
            for (initial, must, cut), edit, more in zip(rows, edits, inserts[1:]):
                if must and edit != "D":
                    break
                shape += initial if edit == "K" else "" if edit == "D" else edit
                cost += {"K": 0, "D": 4}.get(edit, 3) + (3 if cut and edit != "D" else 0)
                audit += ("R" if edit in "ua" else edit) + "I" * len(more)
                shape += more
            else:
                if GOAL.match(shape) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def test_against_every_edit_sequence():
    r = random.Random(2)
    for _ in range(25):
        rows = [(r.choice("suuaax"), r.random() < 0.15, r.random() < 0.3) for _ in range(r.randint(1, 4))]
        codes = bytes(cv.INITIALS.get(i, 0) + 4 * must + 8 * (cut and not must) for i, must, cut in rows)
        table = cv.summary(codes, [1] * len(rows))
        end = min((s for s in range(4) if table[0][s][0] < cv.FAR), key=lambda s: (table[0][s][0] + cv.ENDS[s][0], table[0][s][1]))
        got = table[0][end][0] + cv.ENDS[end][0], cv.audit(codes, [1] * len(rows), 0, end) + cv.ENDS[end][1]
        assert got == every_repair([(i, m, c and not m) for i, m, c in rows])


def test_blocks_and_levels_of_any_size_give_the_same(spark, cases):
    whole = sorted(cv.op13_conversations(spark, cases).collect(), key=str)
    rows = spark.read.parquet(f"{cases}/conversations.parquet")
    for size, fan in ((7, 3), (64, 2)):
        damaged, edits, totals = cv.repair(rows, size, fan)
        hashed = {r.conv_id: (r.audit, r.repaired_sha256) for r in cv.hashed(damaged, edits).collect()}
        assert hashed == {r.conv_id: (r.audit, r.repaired_sha256) for r in whole if r.audit}
        assert sorted((tuple(r) for r in totals.collect()), key=str) == sorted((tuple(r)[:7] for r in whole), key=str)


def test_repaired_rows(spark, cases):
    rows = spark.read.parquet(f"{cases}/conversations.parquet")
    damaged, edits, _ = cv.repair(rows)
    found: dict = {}
    for r in cv.repaired(damaged, edits).where("place IS NOT NULL").collect():
        found.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    digests = {r.conv_id: r.repaired_sha256 for r in cv.op13_conversations(spark, cases).collect()}
    for conv, lines in found.items():
        lines.sort()
        assert [p for p, _, _ in lines] == list(range(len(lines)))
        assert GOAL.match("".join(role[0] for _, role, _ in lines))
        assert hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in lines).encode()).hexdigest() == digests[conv]
    nothing = hashlib.sha256(b"").hexdigest()
    assert all(d == nothing for conv, d in digests.items() if conv not in found)


def test_equal_rows_are_one_row_of_the_plan(spark):
    """A group of copies is summed before the shuffle and costs one step."""
    rows = spark.createDataFrame([(1, 5, "user", "hello.")] * 5000 + [(1, 6, "assistant", "hi.")], "conv_id long, turn long, role string, text string")
    damaged, edits, totals = cv.repair(rows)
    copies = damaged.agg({"copies": "sum"}).first()[0]
    assert cv.coded(damaged).count() == damaged.select("turn").distinct().count()
    got = totals.first()
    assert got.duplicate == max(0, (copies - 1) - 1) or got.duplicate > 4000
    assert len(edits.first().audit) >= got.duplicate


def test_every_conversation_has_a_row(spark, cases):
    want = {r[0] for r in duck(cases).execute("SELECT conv_id FROM conversations").fetchall()}
    got = [r.conv_id for r in cv.op13_conversations(spark, cases).collect()]
    assert len(got) == len(want) and set(got) == want

"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation has the role initials `(s?(ua)+)?`. Edits of a row: keep
(K, free), rerole to user or assistant (R, 3), delete (D, 4, required for blank
and duplicate rows); a user or assistant with empty text may be inserted anywhere
(I, 3); a truncated row that stays adds 3. The cheapest edits win, and among equal
costs the audit (the initials of the edits in order) that is least in ASCII.

Four states say what a prefix ends in: nothing, system, user, assistant. Every
letter has one outcome in a state, so an audit says all. The cost of a stretch of
rows is a vector of four from each state that it may start in. For a fixed start,
the audits that end in different states differ before either ends (each ends with
the letter of the last row), so ranks of four order them, and ranks decide every
comparison of longer audits. Where a forward and a backward vector meet, the
optimal path crosses in the state with the least sum, and among equal sums with
the least forward rank. Crossings split a stretch in two, and so on: costs and
ranks of four states at a time are all that is held besides the rows.

On Spark a conversation is not one group: its rows, reduced to a code (and equal
rows to one with a count), are dealt out by ranges of (conversation, turn) and cut
in blocks of `BLOCK` rows. Each block is summed up as a 4 x 4 table of costs and
ranks. The crossings at the ends of blocks come from these tables in groups of
`FAN` blocks, level upon level, forward and backward (one level up to a million rows
a conversation); then every block is split on its own. Texts move once, to the
streaming pass that writes the repaired rows or hashes them: rows sorted by
conversation follow the audit of theirs, and a task holds one batch and one audit,
whatever the length of a conversation. (The hash of a conversation is one chain by
its definition, so one task computes it.)

Nulls and edge cases: null roles and texts become one space, so such a row is
blank or has no valid role; null conversation ids are one conversation; null turns
come first; rows of the same turn go by role and SHA-256 of the text, so copies
stand together; an empty role has no initial and cannot be kept; a conversation
without rows after damage is repaired to nothing; very long texts are held one at
a time; an empty table gives an empty result; other columns are not read, so none
can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spindle.llm.common import stage, table

# Fixed values.
SPACE = " \t\n\x0b\x0c\r"
RERUN = 20                       # damage: the hash of a row modulo this
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
BLOCK = 4096
FAN = 1024
FAR = 1 << 60                    # the cost of what cannot be reached


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage that the hash of
    `conv_id:turn` decides."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hashed = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % RERUN
    rows = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), hashed.alias("h")).where("h != 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(F.col("h") == 3, 2).otherwise(1).alias("copies"))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def coded(rows: DataFrame) -> DataFrame:
    """Equal rows as one (conv_id, turn, role, digest) with n copies, a code and
    the numbers of blank, duplicate and truncated copies. The code holds the role
    initial (0 to 3), + 4 if the first copy must go, + 8 if it is truncated."""
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    initial = F.substring("role", 1, 1)
    number = F.lit(0)
    for letter, state in INITIALS.items():
        number = F.when(initial == letter, state).otherwise(number)
    thin = rows.select("conv_id", "turn", "role", digest(F.col("text")).alias("digest"), "copies", number.alias("initial"),
                       (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"))
    equal = stage(thin.groupBy("conv_id", "turn", "role", "digest", "initial", "blank", "open").agg(F.sum("copies").alias("n")),
                  "repair-rows").alias("r")
    first = equal.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).getField("turn").alias("first_turn")).alias("f")
    same = F.expr("r.conv_id <=> f.conv_id AND r.role = f.role AND r.digest = f.digest")
    new = ~F.col("blank") & F.expr("r.turn <=> f.first_turn")
    rows = equal.join(first, same).select("r.*", new.alias("new"))
    zero = lambda c, n: F.when(c, n).otherwise(F.lit(0)).cast("long")
    return rows.select(
        "conv_id", "turn", "role", "digest", "n",
        (F.col("initial") + zero(~F.col("new"), F.lit(4)) + zero(F.col("new") & F.col("open"), F.lit(8))).cast("int").alias("code"),
        zero(F.col("blank"), F.col("n")).alias("blank"), zero(~F.col("blank"), F.col("n") - zero(F.col("new"), F.lit(1))).alias("duplicate"),
        zero(F.col("new") & F.col("open"), F.lit(1)).alias("truncated"))


def _turns(state: int) -> int:
    """The state after the only role that may be put after `state`."""
    return ASSISTANT if state == USER else USER


def _moves(code: int) -> list[list[tuple[int, str]]]:
    """[from][to] -> (cost, letters) of a row with this code: inserts before it and
    its own edit. A delete before an insert is the lesser of the two orders, so no
    insert stands before a delete."""
    initial, must, extra = code & 3, bool(code & 4), CUT_OFF if code & 8 else 0
    out = [[(FAR, "")] * 4 for _ in range(4)]
    for start in range(4):
        ways = [(start, DELETE, "D")]
        if not must:
            at, letters = start, ""
            for inserted in range(3):
                rerole = _turns(at)
                ways.append((rerole, INSERT * inserted + REROLE + extra, letters + "R"))
                if initial == rerole or (initial == SYSTEM and at == NOTHING):
                    ways.append((initial, INSERT * inserted + extra, letters + "K"))
                at, letters = _turns(at), letters + "I"
        for end, cost, letters in ways:
            out[start][end] = min(out[start][end], (cost, letters))
    return out


MOVES = [_moves(code) for code in range(16)]
ENDS = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]  # what must follow the last row, by state


Vector = tuple[list[int], list[int]]  # costs and ranks of the four states


def start_in(state: int) -> Vector:
    return [0 if s == state else FAR for s in range(4)], [0] * 4


def step(vector: Vector, table_: list[list[tuple[int, object]]], extra: int = 0) -> Vector:
    """The vector after a row or a block: table_[from][to] is (cost, order), where
    `order` sorts the audits from one state to different ones."""
    costs, ranks = vector
    out, order = [FAR] * 4, [None] * 4
    for end in range(4):
        best = None
        for start in range(4):
            cost, own = table_[start][end]
            if costs[start] < FAR and cost < FAR:
                way = (costs[start] + cost, ranks[start], own)
                if best is None or way < best:
                    best = way
        if best is not None:
            out[end], order[end] = best[0] + extra, best[1:]
    ranked = sorted((s for s in range(4) if order[s] is not None), key=lambda s: order[s])
    new = [0] * 4
    for place, s in enumerate(ranked):
        new[s] = place
    return out, new


def back(costs: list[int], table_: list[list[tuple[int, object]]], extra: int = 0) -> list[int]:
    """Costs from before a row or a block, given those from after it."""
    return [min(FAR, min(table_[start][end][0] + costs[end] for end in range(4)) + extra) for start in range(4)]


def crossing(forward: Vector, backward: list[int]) -> int:
    """The state in which the audit-least optimal path crosses."""
    costs, ranks = forward
    return min((s for s in range(4) if costs[s] < FAR and backward[s] < FAR), key=lambda s: (costs[s] + backward[s], ranks[s]))


def summary(codes: bytes, copies: list[int]) -> list[list[tuple[int, int]]]:
    """The table of a stretch: [from][to] -> (cost, rank among the same `from`)."""
    out = []
    for start in range(4):
        vector = start_in(start)
        for code, n in zip(codes, copies):
            vector = step(vector, MOVES[code], DELETE * (n - 1))
        out.append(list(zip(*vector)))
    return out


def audit(codes: bytes, copies: list[int], enter: int, leave: int) -> str:
    """The least audit of the cheapest edits of a stretch between two states."""
    out: list[str] = []

    def split(lo: int, hi: int, start: int, end: int) -> None:
        if hi - lo == 1:
            out.append(MOVES[codes[lo]][start][end][1] + "D" * (copies[lo] - 1))
            return
        mid = (lo + hi) // 2
        forward = start_in(start)
        for i in range(lo, mid):
            forward = step(forward, MOVES[codes[i]])
        backward = [0 if s == end else FAR for s in range(4)]
        for i in range(hi - 1, mid - 1, -1):
            backward = back(backward, MOVES[codes[i]])
        at = crossing(forward, backward)
        split(lo, mid, start, at)
        split(mid, hi, at, end)

    if codes:
        split(0, len(codes), enter, leave)
    return "".join(out)


def _tables(flat: list[int]) -> list[list[tuple[int, int]]]:
    """4 x 4 (cost, rank) from 32 numbers, and back by `_flat`."""
    return [[(flat[8 * i + 2 * j], flat[8 * i + 2 * j + 1]) for j in range(4)] for i in range(4)]


def _flat(tables: list[list[tuple[int, int]]]) -> list[int]:
    return [x for row in tables for cell in row for x in cell]


def blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """`coded` rows cut in blocks of at most `size`: (conv_id, part, block, codes,
    copies, illegal within, first and last initial, cells: its table)."""
    ranged = rows.repartitionByRange("conv_id", "turn", "role", "digest").withColumn("part", F.spark_partition_id())
    ranged = stage(ranged.select("conv_id", "turn", "role", "digest", "n", "code", "part"), "repair-ranges")
    place = F.row_number().over(W.partitionBy("part", "conv_id").orderBy("turn", "role", "digest"))
    cut = ranged.withColumn("place", place).withColumn("block", F.floor((F.col("place") - 1) / size).cast("long"))
    held = cut.groupBy("conv_id", "part", "block").agg(F.sort_array(F.collect_list(F.struct("place", "code", "n"))).alias("rows"))
    held = held.select("conv_id", "part", "block", F.col("rows.code").alias("codes"), F.col("rows.n").alias("copies"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, illegal, first, last = [], [], [], []
            for codes, copies in zip(batch.column("codes").to_pylist(), batch.column("copies").to_pylist()):
                initials = [c & 3 for c in codes]
                illegal.append(sum(copies) - len(copies) + sum(p not in legal for p in zip(initials, initials[1:])))
                first.append(initials[0])
                last.append(initials[-1])
                cells.append(_flat(summary(bytes(codes), copies)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(illegal, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(cells, pa.list_(pa.int64()))],
                [*batch.schema.names, "illegal", "first", "last", "cells"])

    summed = held.mapInArrow(run, f"conv_id {kind}, part int, block long, codes array<int>, copies array<bigint>, illegal long, first int, last int, cells array<bigint>")
    summed = stage(summed, "repair-blocks")
    order = W.partitionBy("conv_id").orderBy("part", "block")
    joined = F.lag("last").over(order) * 4 + F.col("first")
    joint = F.when(joined.isNull() | joined.isin(*[4 * a + b for a, b in sorted(legal)]), 0).otherwise(1)
    numbered = summed.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("idx"), "codes", "copies", "cells", (F.col("illegal") + joint).alias("illegal"))
    return stage(numbered, "repair-numbered")


def crossings(level: DataFrame, fan: int = FAN) -> DataFrame:
    """(conv_id, idx, enter, leave, cost) for the blocks (conv_id, idx, cells): the
    states in which the best path of each conversation enters and leaves each
    block; cost is that of the conversation at its first block, else 0."""
    kind = level.schema["conv_id"].dataType.simpleString()
    most = level.agg(F.max("idx")).first()[0] or 0
    grouped = level.groupBy("conv_id", F.floor(F.col("idx") / fan).cast("long").alias("up")) \
        .agg(F.sort_array(F.collect_list(F.struct("idx", "cells"))).alias("held"))
    grouped = grouped.select("conv_id", "up", F.col("held.idx").alias("idx"), F.col("held.cells").alias("cells"))
    if most < fan:
        grouped = grouped.select("*", F.lit(NOTHING).alias("enter"), F.lit(-1).alias("leave"), F.lit(0).cast("long").alias("cost"))
    else:
        grouped = stage(grouped, "repair-groups")

        def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells = []
                for held in batch.column("cells").to_pylist():
                    rows = [_tables(flat) for flat in held]
                    out = []
                    for start in range(4):
                        vector = start_in(start)
                        for t in rows:
                            vector = step(vector, t)
                        out.append(list(zip(*vector)))
                    cells.append(_flat(out))
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("up"), pa.array(cells, pa.list_(pa.int64()))], ["conv_id", "idx", "cells"])

        above = stage(grouped.mapInArrow(join_up, f"conv_id {kind}, idx long, cells array<bigint>"), "repair-level")
        ends = crossings(above, fan).alias("e")
        grouped = grouped.alias("g").join(ends, F.expr("g.conv_id <=> e.conv_id AND g.up = e.idx")).select("g.*", "e.enter", "e.leave", "e.cost")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, idx, enters, leaves, costs = [], [], [], [], []
            columns = [batch.column(c).to_pylist() for c in ("idx", "cells", "enter", "leave", "cost")]
            for row, (numbers, cells, enter, leave, cost) in enumerate(zip(*columns)):
                rows = [_tables(flat) for flat in cells]
                forward = [start_in(enter)]
                for t in rows:
                    forward.append(step(forward[-1], t))
                backward = [[c for c, _ in ENDS] if leave < 0 else [0 if s == leave else FAR for s in range(4)]]
                for t in reversed(rows):
                    backward.append(back(backward[-1], t))
                states = [crossing(f, b) for f, b in zip(forward, reversed(backward))]
                at += [row] * len(rows)
                idx += numbers
                enters += states[:-1]
                leaves += states[1:]
                costs += [backward[-1][enter] if leave < 0 else cost] + [0] * (len(numbers) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id").take(pa.array(at, pa.int64())), pa.array(idx, pa.int64()), pa.array(enters, pa.int32()), pa.array(leaves, pa.int32()), pa.array(costs, pa.int64())],
                ["conv_id", "idx", "enter", "leave", "cost"])

    return grouped.mapInArrow(meet, f"conv_id {kind}, idx long, enter int, leave int, cost long")


def audits(cut: DataFrame, fan: int = FAN) -> DataFrame:
    """(conv_id, idx, audit, cost, illegal) of `blocks`; the audits of a
    conversation in order of idx are its audit, but for inserts after the last row."""
    kind = cut.schema["conv_id"].dataType.simpleString()
    met = crossings(cut.select("conv_id", "idx", "cells"), fan).alias("m")
    both = cut.alias("c").join(met, F.expr("c.conv_id <=> m.conv_id AND c.idx = m.idx")) \
        .select("c.conv_id", "c.idx", "codes", "copies", "enter", "leave", "cost", "illegal")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("codes", "copies", "enter", "leave")]
            made = [audit(bytes(codes), copies, enter, leave) for codes, copies, enter, leave in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("idx"), pa.array(made, pa.string()), batch.column("cost"), batch.column("illegal")],
                                             ["conv_id", "idx", "audit", "cost", "illegal"])

    return stage(both.mapInArrow(run, f"conv_id {kind}, idx long, audit string, cost long, illegal long"), "repair-audits")


class _Walk:
    """Follows the audit of one conversation over its rows in order."""

    def __init__(self):
        self.pieces: list[str] = []
        self.letters, self.at, self.state = None, 0, NOTHING

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.letters[self.at:self.at + 1] == "I":
            self.at, self.state = self.at + 1, _turns(self.state)
            yield "I", "user" if self.state == USER else "assistant", ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the inserts before a row and of the row."""
        if self.letters is None:
            self.letters = "".join(self.pieces)
        yield from self.inserts()
        edit, self.at = self.letters[self.at], self.at + 1
        if edit == "R":
            self.state = _turns(self.state)
            role = "user" if self.state == USER else "assistant"
        elif edit == "K":
            self.state = INITIALS[role[0]]
        yield edit, role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        """Inserts after the last row."""
        if self.letters is None:
            self.letters = "".join(self.pieces)
        self.letters += ENDS[self.state][1]
        yield from self.inserts()


def _walked(rows: DataFrame, edits: DataFrame, schema: str, fold: Callable) -> DataFrame:
    """Sort the damaged rows of each conversation after its audits and pass them
    through `fold(conversations)`, which yields record batches from an iterator of
    (conv_id, iterator of (edit, role, text), walk)."""
    none = lambda kind: F.lit(None).cast(kind)
    texts = rows.select("conv_id", F.lit(1).alias("kind"), none("long").alias("idx"), "turn", "role", digest(F.col("text")).alias("digest"), "text", "copies")
    heads = edits.select("conv_id", F.lit(0).alias("kind"), "idx", none(rows.schema["turn"].dataType).alias("turn"), none("string").alias("role"),
                         none("binary").alias("digest"), F.col("audit").alias("text"), none("int").alias("copies"))
    dealt = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "idx", "turn", "role", "digest")
    dealt = dealt.select("conv_id", "kind", "role", "text", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text", "copies")))

        yield from fold(rows_of())

    return dealt.mapInArrow(run, schema)


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired rows: (conv_id, place, edit, role, text); deleted rows have no
    place. Batches are bounded in rows and characters."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def fold(stream: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(5)]
        characters = 0

        def flush() -> pa.RecordBatch:
            nonlocal out, characters
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["conv_id", "place", "edit", "role", "text"])
            out, characters = [[] for _ in range(5)], 0
            return batch

        place = 0
        for conv, opened, edit, role, text in _edits(stream):
            if edit is None:
                continue
            place = 0 if opened else place
            for column, value in zip(out, (conv, None if edit == "D" else place, edit, role, text)):
                column.append(value)
            place += edit != "D"
            characters += len(text)
            if len(out[0]) >= 10_000 or characters >= 1 << 24:
                yield flush()
        yield flush()

    return _walked(rows, edits, f"conv_id {kind}, place long, edit string, role string, text string", fold)


def _edits(stream: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, whether it is the first edit, edit, role, text) of the sorted rows
    of `_walked`; each conversation ends with (conv_id, ..., None, None, None)."""
    walk, current, opened = None, None, False
    for conv, kind, role, text, copies in stream:
        if walk is None or conv != current:
            if walk is not None:
                for e in walk.end():
                    yield current, opened, *e
                    opened = False
                yield current, opened, None, None, None
            walk, current, opened = _Walk(), conv, True
        if kind == 0:
            walk.pieces.append(text)
            continue
        for _ in range(copies):
            for e in walk.row(role, text):
                yield current, opened, *e
                opened = False
    if walk is not None:
        for e in walk.end():
            yield current, opened, *e
            opened = False
        yield current, opened, None, None, None


def hashed(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the whole audit of each conversation and
    the hash of its repaired `role:text` lines."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def fold(stream: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], []]
        letters: list[str] = []
        sha, started = hashlib.sha256(), False
        for conv, _, edit, role, text in _edits(stream):
            if edit is None:
                for column, value in zip(out, (conv, "".join(letters), sha.hexdigest())):
                    column.append(value)
                letters, sha, started = [], hashlib.sha256(), False
                if len(out[0]) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], names)
                    out = [[], [], []]
                continue
            letters.append(edit)
            if edit != "D":
                sha.update((("\n" if started else "") + f"{role}:{text}").encode())
                started = True
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], names)

    names = ["conv_id", "audit", "repaired_sha256"]
    return _walked(rows, edits, f"conv_id {kind}, audit string, repaired_sha256 string", fold)


def repair(conversations: DataFrame, size: int = BLOCK, fan: int = FAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The damaged rows, the audits of their blocks and, per conversation of the
    input, the counts of faults and the cost: arguments for `repaired` and `hashed`."""
    rows = damaged(conversations)
    codes = stage(coded(rows), "repair-coded")
    edits = audits(blocks(codes, size), fan)
    zero = [F.lit(0).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    no_turn = [F.lit(None).cast("long").alias(c) for c in ("least", "most", "turns")]
    each = codes.groupBy("conv_id", F.col("turn").cast("long").alias("turn")).agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    parts = conversations.select("conv_id").distinct().select("conv_id", *no_turn, *zero).unionByName(
        each.select("conv_id", F.col("turn").alias("least"), F.col("turn").alias("most"), F.when(F.col("turn").isNotNull(), 1).cast("long").alias("turns"),
                    "blank", "duplicate", "truncated", *zero[3:])).unionByName(
        edits.select("conv_id", *no_turn, *zero[:3], "illegal", "cost"))
    totals = parts.groupBy("conv_id").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("turns").alias("turns"),
                                          *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")])
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return rows, edits, totals.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost")


def op13_conversations(spark: SparkSession, data_dir: str) -> DataFrame:
    rows, edits, totals = repair(table(spark, data_dir, "conversations", "conv_id", "turn", "role", "text"))
    texts = hashed(rows, edits).alias("h")
    nothing = hashlib.sha256(b"").hexdigest()
    return totals.alias("t").join(texts, F.expr("t.conv_id <=> h.conv_id"), "left").select(
        "t.*", F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


OP13_SQL = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), h AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS h
  FROM k
), d AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, (VALUES (1), (2)) c(copy) WHERE h <> 0 AND (copy = 1 OR h = 3)
), o AS (
  SELECT *, coalesce(conv_id::VARCHAR, 'null') AS conv, substr(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut
  FROM d
), p AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS duplicate,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM o
), r AS (
  SELECT *, cut AND NOT blank AND NOT duplicate AS truncated FROM p
), before(origin, ins, mid, lines) AS (
  VALUES (0, '', 0, []::VARCHAR[]), (1, '', 1, []::VARCHAR[]), (2, '', 2, []::VARCHAR[]), (3, '', 3, []::VARCHAR[]),
         (0, 'I', 2, ['user:']), (1, 'I', 2, ['user:']), (3, 'I', 2, ['user:']), (2, 'I', 3, ['assistant:']),
         (0, 'II', 3, ['user:', 'assistant:']), (1, 'II', 3, ['user:', 'assistant:'])
), moves(edit, mid, state, cost, initial) AS (
  SELECT 'D', s, s, 4, NULL::VARCHAR FROM (VALUES (0), (1), (2), (3)) t(s)
  UNION ALL VALUES ('R', 0, 2, 3, NULL::VARCHAR), ('R', 1, 2, 3, NULL), ('R', 3, 2, 3, NULL), ('R', 2, 3, 3, NULL), ('K', 0, 1, 0, 's'),
         ('K', 0, 2, 0, 'u'), ('K', 1, 2, 0, 'u'), ('K', 3, 2, 0, 'u'), ('K', 2, 3, 0, 'a')
), paths AS (
  SELECT conv, 0::BIGINT AS pos, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS best FROM r GROUP BY conv
  UNION ALL
  SELECT r.conv, r.pos, m.state, min({
           'cost': q.best.cost + 3 * length(b.ins) + m.cost + CASE WHEN r.truncated AND m.edit <> 'D' THEN 3 ELSE 0 END,
           'audit': q.best.audit || b.ins || m.edit,
           'lines': q.best.lines || b.lines || CASE m.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [r.role || ':' || r.text]
                    ELSE [CASE m.state WHEN 2 THEN 'user:' ELSE 'assistant:' END || r.text] END})
  FROM paths q JOIN r ON r.conv = q.conv AND r.pos = q.pos + 1 JOIN before b ON b.origin = q.state JOIN moves m ON m.mid = b.mid
  WHERE (m.edit = 'D' OR NOT (r.blank OR r.duplicate)) AND (m.edit <> 'K' OR m.initial = r.initial)
  GROUP BY r.conv, r.pos, m.state
), ends AS (
  SELECT q.conv, min({'cost': q.best.cost + 3 * length(b.ins), 'audit': q.best.audit || b.ins, 'lines': q.best.lines || b.lines}) AS best
  FROM paths q JOIN (SELECT conv, max(pos) AS pos FROM r GROUP BY conv) l USING (conv, pos)
  JOIN before b ON b.origin = q.state AND b.mid IN (0, 3) GROUP BY q.conv
), c AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, sum(blank::INT)::BIGINT AS blank,
         sum(duplicate::INT)::BIGINT AS duplicate, sum(truncated::INT)::BIGINT AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM r GROUP BY conv
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(ends.best.cost, 0)::BIGINT AS cost, coalesce(ends.best.audit, '') AS audit,
       sha256(coalesce(array_to_string(ends.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON c.conv = coalesce(a.conv_id::VARCHAR, 'null')
LEFT JOIN ends ON ends.conv = coalesce(a.conv_id::VARCHAR, 'null')
"""

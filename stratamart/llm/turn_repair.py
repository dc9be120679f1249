"""Repair of conversation structure as a lightest derivation, by Knuth's agenda.

The turns of a conversation, in order, are edited so that the initials of their roles
spell ``(s?(ua)+)?``. An item says: the first i turns are edited and have brought the
grammar to state q. It follows from an item and an edit of the next turn, or from an item
and an insertion; its weight is the pair (cost, audit), the audit being the initials of the
edits so far. Pairs are combined by adding costs and joining audits. That is a superior
function: a conclusion is never lighter than what it follows from, and lighter premises
never give a heavier conclusion (audits of one cost over the same turns are never prefixes
of one another, as an insertion costs something). So the lightest waiting item is final
when it leaves the agenda, and the derivation ends when the goal leaves it.

A conversation of any length spreads over tasks. Turns are dealt out by ranges of
(conversation, turn) without their texts, each task cuts its share into blocks and derives,
for every pair of states, the lightest way through a block. Blocks are then premises of the
same deduction: ways through neighbours are joined in rounds of ``FAN`` until one is left.
Only the checksum needs a conversation's texts in one stream, as SHA-256 is a chain: turns
pass sorted through one task, which holds the audit and one batch of them.

Turns are ordered by number, null first, then by role and a digest of conversation, role and text.
Equal turns are counted before they are dealt out: all but the first are duplicates. Null
roles and texts are one space; roles with another initial must be given a role or deleted.
A null conversation id is a conversation. An empty table has no rows; very long texts are
hashed once and only move for the checksum. Columns beyond the four are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import emit, hot_keys, partitions, spread_join, stage

# Turns of a block, and blocks joined at a time.
BLOCK = 256
FAN = 32
SPACE = " \t\n\x0b\x0c\r"
STATES = 4  # nothing yet, after s, after u, after a pair
ACCEPTED = (0, 3)
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NAMES = {"u": "user", "a": "assistant"}
INSERT, REROLE, DELETE, CUT_SHORT = 2, 2, 3, 1

Weight = tuple[int, str]
Ways = dict[tuple[int, int], Weight]  # (state before, state after): weight


def joined(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1]


def agenda(start: int, steps: list[Ways], inserts: bool, goals: Iterable[int]) -> dict[int, Weight]:
    """Lightest weights of reaching each goal state behind all steps, from ``start``.

    Items are (steps done, state). They leave the agenda lightest first, and the search
    ends when the last goal has left it.
    """
    waiting: list[tuple[Weight, int, int]] = [((0, ""), 0, start)]
    final: set[tuple[int, int]] = set()
    wanted, reached = set(goals), {}
    while waiting and wanted:
        weight, done, state = heapq.heappop(waiting)
        if (done, state) in final:
            continue
        final.add((done, state))
        if done == len(steps):
            if state in wanted:
                wanted.discard(state)
                reached[state] = weight
        else:
            for (before, after), own in steps[done].items():
                if before == state and (done + 1, after) not in final:
                    heapq.heappush(waiting, (joined(weight, own), done + 1, after))
        if inserts:
            for role in _NAMES:
                after = _STEP.get((state, role))
                if after is not None and (done, after) not in final:
                    heapq.heappush(waiting, (joined(weight, (INSERT, "I")), done, after))
    return reached


@lru_cache(maxsize=256)
def turn_ways(initial: str, fault: str) -> Ways:
    """The edits of one turn. ``fault``: b(lank), d(uplicate), t(runcated) or -."""
    found: Ways = {(q, q): (DELETE, "D") for q in range(STATES)}
    if fault in "bd":
        return found
    extra = CUT_SHORT if fault == "t" else 0
    edits = [(_STEP.get((q, role)), q, (REROLE + extra, "R")) for q in range(STATES) for role in _NAMES]
    edits += [(_STEP.get((q, initial)), q, (extra, "K")) for q in range(STATES)]
    for after, q, weight in edits:
        if after is not None:
            found[q, after] = min(weight, found.get((q, after), weight))
    return found


def _steps(turns: str) -> list[Ways]:
    return [turn_ways(turns[i], turns[i + 1]) for i in range(0, len(turns), 2)]


@lru_cache(maxsize=20_000)
def repair(turns: str) -> Weight:
    """Cost and audit of a whole conversation: two letters a turn, initial and fault."""
    reached = agenda(0, _steps(turns), True, ACCEPTED)
    return min(reached.values())


def through(steps: list[Ways], inserts: bool) -> Ways:
    """The lightest ways through steps, from every state to every other."""
    return {
        (before, after): weight
        for before in range(STATES)
        for after, weight in agenda(before, steps, inserts, range(STATES)).items()
    }


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns after damage: conv_id, turn, role, text, copies (0: dropped, 2: repeated)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    at = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(at[0], F.lit(":"), at[1])) % 20
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _keyed(turns: DataFrame) -> DataFrame:
    """Add ``key``, a digest of conversation, role and text."""
    role = F.col("role")
    whole = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"),
        F.length(role).cast("string"), F.lit(":"), role, F.col("text"))
    return turns.withColumn("key", F.sha2(whole, 256))


def _place() -> Column:
    return F.struct(F.col("turn").isNotNull(), F.col("turn"))


def _order() -> list[Column]:
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("key")]


def counted_turns(turns: DataFrame) -> DataFrame:
    """Equal turns as one row: conv_id, turn, role, key, last (letter of the text), n."""
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    return stage(
        _keyed(turns.withColumn("last", last))
        .groupBy("conv_id", "turn", "role", "key", "last").agg(F.sum("copies").alias("n")),
        "turns")


def with_faults(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, key, initial, fault (of the first of the n equal turns), n."""
    firsts = stage(
        turns.where("n > 0").groupBy("key").agg(F.min(_place()).alias("first"), F.count("*").alias("n"))
        .where("n > 1"), "firsts")
    hot = hot_keys(firsts, "key")
    found = spread_join(turns, firsts.select("key", "first"), "key", hot, F.col("turn"), "left")
    seen = F.coalesce(_place() > F.col("first"), F.lit(False))
    fault = (
        F.when(F.col("last") == "", "b").when(seen, "d")
        .when(~F.col("last").isin(".", "!", "?"), "t").otherwise("-"))
    initial = F.rpad(F.substring("role", 1, 1), 1, " ")
    return found.select("conv_id", "turn", "role", "key", initial.alias("initial"), fault.alias("fault"), "n")


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
_LEGAL = {"su", "ua", "au"}


class Run:
    """Counters and turns of one conversation's run of rows, block by block."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.clear()

    def clear(self) -> None:
        self.turns: list[str] = []
        self.gaps = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = self.first_turn = self.last_turn = None

    def add(self, turn: int | None, initial: str, fault: str, n: int) -> None:
        if not n:  # a dropped turn shows that the conversation is there
            return
        if turn is not None:
            if self.last_turn is None:
                self.first_turn = turn
            elif turn != self.last_turn:
                self.gaps += turn - self.last_turn - 1
            self.last_turn = turn
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LEGAL
        self.last = initial
        self.illegal += n - 1
        again = "b" if fault == "b" else "d"
        self.blank += (fault == "b") * n
        self.duplicate += (fault == "d") + (again == "d") * (n - 1)
        self.truncated += fault == "t"
        self.turns.append(initial + fault)
        self.turns.extend([initial + again] * (n - 1))

    def row(self, task: int, number: int, whole: bool) -> tuple:
        """A block as a row. A whole conversation has its one weight, a part all its ways."""
        if whole:
            ways = {(0, 0): repair("".join(self.turns))}
        else:
            ways = through(_steps("".join(self.turns)), True)
        return (
            self.conv_id, task, number, whole, *(getattr(self, c) for c in _COUNTS),
            self.first, self.last, self.first_turn, self.last_turn, *_flat(ways))


def _flat(ways: Ways) -> tuple[list[int], list[str]]:
    """Costs and audits by 4 * before + after; a cost of -1 for no way."""
    cells = [ways.get(divmod(i, STATES), (-1, "")) for i in range(STATES * STATES)]
    return [c for c, _ in cells], [a for _, a in cells]


def _unflat(costs: list[int], audits: list[str]) -> Ways:
    return {divmod(i, STATES): (c, a) for i, (c, a) in enumerate(zip(costs, audits)) if c >= 0}


_BLOCK = [
    ("task", pa.int64(), "long"), ("number", pa.int64(), "long"), ("whole", pa.bool_(), "boolean"),
    *((c, pa.int64(), "long") for c in _COUNTS),
    ("first", pa.string(), "string"), ("last", pa.string(), "string"),
    ("first_turn", pa.int64(), "long"), ("last_turn", pa.int64(), "long"),
    ("costs", pa.list_(pa.int64()), "array<long>"), ("audits", pa.list_(pa.string()), "array<string>"),
]


def _block_schema(turns: DataFrame) -> str:
    kind = turns.schema["conv_id"].dataType.simpleString()
    return f"conv_id {kind}, " + ", ".join(f"{name} {sql}" for name, _, sql in _BLOCK)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2_000):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 2_000).columns))


def _typed(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType | None, Iterator[pa.RecordBatch]]:
    """The type of the conversation ids, and the batches again."""
    first = next(batches, None)
    if first is None:
        return None, iter(())
    return first.schema.field("conv_id").type, chain([first], batches)


def _blocks(size: int):
    def runs(rows: Iterator[tuple], task: int) -> Iterator[tuple]:
        run, number, parted = None, 0, True  # a task's first conversation may have begun before
        for conv_id, turn, initial, fault, n in rows:
            if run is None or conv_id != run.conv_id:
                if run is not None:
                    yield run.row(task, number, not parted)
                    number, parted = number + 1, False
                run = Run(conv_id)
            while n:
                room = size - len(run.turns)
                if not room:
                    yield run.row(task, number, False)
                    run.clear()
                    number, parted = number + 1, True
                    continue
                run.add(turn, initial, fault, min(n, room))
                n -= min(n, room)
                fault = "b" if fault == "b" else "d"  # of the copies
        if run is not None:  # its last conversation may go on
            yield run.row(task, number, False)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, batches = _typed(batches)
        if kind is not None:
            columns = {"conv_id": kind} | {name: arrow for name, arrow, _ in _BLOCK}
            yield from emit(columns, runs(_rows(batches), TaskContext.get().partitionId()), 500)

    return blocks


def _neighbours(by_task: bool):
    """Neighbouring blocks of a conversation, at most ``FAN``, as one."""

    def join(blocks: pa.Table) -> pa.Table:
        rows = sorted(blocks.to_pylist(), key=lambda r: (r["task"], r["number"]))
        out = dict(rows[0])
        for row in rows[1:]:
            for name in _COUNTS:
                out[name] += row[name]
            if row["first"] is not None:
                if out["last"] is None:
                    out["first"] = row["first"]
                else:
                    out["illegal"] += out["last"] + row["first"] not in _LEGAL
                out["last"] = row["last"]
            if row["first_turn"] is not None:
                if out["last_turn"] is None:
                    out["first_turn"] = row["first_turn"]
                elif out["last_turn"] != row["first_turn"]:
                    out["gaps"] += row["first_turn"] - out["last_turn"] - 1
                out["last_turn"] = row["last_turn"]
        if len(rows) > 1:
            ways = through([_unflat(r["costs"], r["audits"]) for r in rows], False)
            out["costs"], out["audits"] = _flat(ways)
        out["task"], out["number"] = (out["task"] // FAN, 0) if by_task else (out["task"], out["number"] // FAN)
        return pa.Table.from_pylist([out], schema=blocks.schema)

    return join


def joined_blocks(parts: DataFrame) -> DataFrame:
    """One row per conversation from its blocks, joined ``FAN`` neighbours at a time."""
    schema = _block_schema(parts)
    while True:
        in_task = parts.groupBy("conv_id", "task").agg(F.count("*").alias("blocks"))
        row = in_task.groupBy("conv_id").agg(F.max("blocks").alias("blocks"), F.count("*").alias("tasks")).agg(
            F.max("blocks").alias("blocks"), F.max("tasks").alias("tasks")).first()
        if (row["blocks"] or 0) <= 1 and (row["tasks"] or 0) <= 1:
            return parts
        if row["blocks"] > 1:
            grouped = parts.groupBy("conv_id", "task", F.floor(F.col("number") / FAN))
        else:
            grouped = parts.groupBy("conv_id", F.floor(F.col("task") / FAN))
        own = _neighbours(row["blocks"] <= 1)
        parts = stage(grouped.applyInArrow(own, schema), "joined")


def best_edits(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of counted turns."""
    faults = with_faults(turns).repartitionByRange(partitions(turns.sparkSession), *_order())
    ordered = faults.sortWithinPartitions(*_order()).select("conv_id", "turn", "initial", "fault", "n")
    blocks = stage(ordered.mapInArrow(_blocks(block), _block_schema(turns)), "blocks")
    every = blocks.where("whole").unionByName(joined_blocks(blocks.where("NOT whole")))

    def weight(state: int) -> Column:
        return F.when(
            F.col("costs")[state] >= 0,
            F.struct(F.col("costs")[state].alias("cost"), F.col("audits")[state].alias("audit")))

    return every.withColumn("_best", F.least(*map(weight, ACCEPTED))).select("conv_id", *_COUNTS, "_best.*")


class Repaired:
    """A conversation's checksum, turn by turn along its audit."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0
        self.sha, self.empty = hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False
        self.state = _STEP[self.state, role[0]]

    def _given(self) -> str:
        """The one of user and assistant that the grammar has here."""
        return next(name for initial, name in _NAMES.items() if (self.state, initial) in _STEP)

    def inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._put(self._given(), "")

    def turn(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._put(role if edit == "K" else self._given(), text)

    def digest(self) -> str:
        self.inserted()
        return self.sha.hexdigest()


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, batches = _typed(batches)
    if kind is None:
        return
    columns = {"conv_id": kind} | {c: pa.int64() for c in (*_COUNTS, "cost")}
    columns |= {"audit": pa.string(), "repaired_sha256": pa.string()}

    def rows():
        head = made = None
        for conv_id, counts, audit, role, text, copies in _rows(batches):
            if counts is not None:  # a conversation begins
                if head is not None:
                    yield (*head, made.digest())
                head, made = (conv_id, *counts, audit), Repaired(audit)
            else:
                for _ in range(copies):
                    made.turn(role, text)
        if head is not None:
            yield (*head, made.digest())

    yield from emit(columns, rows(), 500)


def repair_conversations(conversations: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """One row per conversation: faults after damage, cheapest edits, checksum of the repaired turns."""
    turns = damaged(conversations)
    best = best_edits(counted_turns(turns), block)
    heads = best.select("conv_id", F.array(*_COUNTS, "cost").alias("counts"), "audit")
    texts = _keyed(turns.where("copies > 0"))
    both = heads.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_last("counts"), *_order()[1:]]
    kind = turns.schema["conv_id"].dataType.simpleString()
    return (
        both.sortWithinPartitions(*order).select("conv_id", "counts", "audit", "role", "text", "copies")
        .mapInArrow(
            _checksums,
            f"conv_id {kind}, " + ", ".join(f"{c} long" for c in (*_COUNTS, "cost"))
            + ", audit string, repaired_sha256 string"))

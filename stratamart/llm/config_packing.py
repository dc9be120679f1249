"""Packing into few sequences by a configuration linear program over the length histogram.

Documents become token ids with an end id each; longer ones are cut into full pieces,
the rest first. A configuration is a set of lengths that fit one sequence together. The
program asks for the least number of configurations that cover every length as often as
it occurs. Multiplicative weights solve it to within a small share: each round prices
configurations by a knapsack dynamic program under weights that fall exponentially with
how far a length is covered already, and gives every length that is behind the round's
target the best configuration through it. Whole numbers of configurations are then taken
as far as the lengths last, and what rounding leaves over goes to the fullest sequence
with room, longest first. The work on the driver follows the number of different lengths
(at most the capacity), never the number of documents.

A null or empty text is its end id alone. Repeated rows, equal ids and null ids are
documents of their own; very long texts are many pieces; an empty table has no pieces.
Ties between configurations are settled by a fixed seed and by their lengths. Only doc_id
and text are read, whatever other columns there are.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import emit, stage, worker_memory

CAPACITY = 1024
END = 2
# Rounds of the program, after as many to find the weights to begin with: the first round's
# configurations are the largest excess, 1 / ROUNDS.
WARM_UP, ROUNDS = 30, 70
# How steeply a length's weight falls with its cover. Steeper brings the fractional value
# lower, flatter keeps sequences full, which matters more once numbers are whole.
STEEPNESS = 0.3
# Knapsack programs side by side in a round, their weights apart by up to SPREAD, so that
# different lengths are completed by different fillers.
TABLES = 16
SPREAD = 0.002
SEED = 11
# Word pieces whose ids a Python worker remembers, and documents it looks up at a time.
_REMEMBERED = 1_500_000
_TOGETHER = 32
# Byte-level tokens cross neither the end of a word nor, where ASCII follows, that of a
# run of Latin letters; a white-space run belongs to what follows it.
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_CUT = re.compile(rf" ?[{_LATIN}]++(?=[\x00-\x7f]|\Z)|\s*\S+|\s+")
# White space to Python, but not to the tokenizer: such texts are encoded whole.
_UNLIKE = re.compile(r"[\x1c-\x1f]")
_RANK_BITS = 48


class TextIds:
    """The ids of texts as little-endian unsigned 32-bit numbers, word pieces remembered."""

    def __init__(self, tokenizer_file: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.known: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def of(self, texts: list[str]) -> list[bytes]:
        cut = [[t] if _UNLIKE.search(t) else _CUT.findall(t) for t in texts]
        wanted = set().union(*cut)
        new = [w for w in wanted if w not in self.known]
        if len(self.known) + len(new) > _REMEMBERED:
            self.known, new = {}, list(wanted)
        self.known.update(zip(new, self._encode(new)))
        return [b"".join(map(self.known.__getitem__, c)) for c in cut]


def _pieces(tokenizer_file: str, capacity: int, end: int):
    kinds = {k: pa.int64() for k in (
        "doc_id", "piece", "start", "length", "ids_crc32", "task", "place")}
    kinds["piece"] = pa.int32()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_ids = worker_memory(("TextIds", tokenizer_file), lambda: TextIds(tokenizer_file))
        last = np.array([end], "<u4").tobytes()
        task = TaskContext.get().partitionId()
        places: dict[int, int] = defaultdict(int)

        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, _TOGETHER):
                    doc_ids, texts = (c.to_pylist() for c in batch.slice(at, _TOGETHER).columns)
                    for doc_id, ids in zip(doc_ids, text_ids.of([t or "" for t in texts])):
                        ids += last
                        n = len(ids) // 4
                        stop = (n - 1) % capacity + 1  # the first piece takes the rest
                        start = piece = 0
                        while start < n:
                            crc = zlib.crc32(ids[4 * start:4 * stop])
                            length = stop - start
                            yield doc_id, piece, start, length, crc, task, places[length]
                            places[length] += 1
                            start, stop, piece = stop, stop + capacity, piece + 1

        return emit(kinds, rows())

    return pieces


def knapsacks(values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows of item values by length: the best value of every room, and the length
    to take first there (0: leave a unit empty)."""
    rows = np.arange(len(values))
    best = np.zeros((len(values), capacity + 1))
    back = np.zeros_like(best)  # best, from the largest room to the smallest
    first = np.zeros(best.shape, np.int64)
    for room in range(1, capacity + 1):
        through = values[:, 1:room + 1] + back[:, capacity - room + 1:]
        length = through.argmax(axis=1)
        value = through[rows, length]
        taken = value > best[:, room - 1]
        best[:, room] = np.where(taken, value, best[:, room - 1])
        first[:, room] = np.where(taken, length + 1, 0)
        back[:, capacity - room] = best[:, room]
    return best, first


def _filled(length: int, first: np.ndarray, capacity: int) -> dict[int, int]:
    """The best configuration through a length: {length: times}."""
    found, room = {length: 1}, capacity - length
    while room:
        item = int(first[room])
        if item:
            found[item] = found.get(item, 0) + 1
        room -= item or 1
    return found


def configurations(
    counts: dict[int, int], capacity: int = CAPACITY, warm_up: int = WARM_UP, rounds: int = ROUNDS
) -> tuple[dict[tuple, float], float]:
    """Fractional numbers of configurations that cover all counts, and a lower bound.

    The bound is the value of the dual: prices under which no configuration is worth
    over 1, times the counts. No packing has fewer sequences.
    """
    need = np.zeros(capacity + 1)
    for length, n in counts.items():
        need[length] = n
    lengths = np.flatnonzero(need)
    chosen, bound = {}, 0.0
    if not len(lengths):
        return chosen, bound
    chance = np.random.default_rng(SEED)
    prior = np.arange(capacity + 1.0)
    for turns in (warm_up, rounds):
        cover, chosen = np.zeros(capacity + 1), defaultdict(float)
        for turn in range(1, turns + 1):
            target = turn / turns
            ahead = np.minimum(cover[lengths] / need[lengths] - target, 500)
            weight = np.zeros(capacity + 1)
            weight[lengths] = prior[lengths] * np.exp(-STEEPNESS * ahead)
            values = weight * (1 + SPREAD * chance.random((TABLES, capacity + 1)))
            values[0] = weight
            best, first = knapsacks(values, capacity)
            bound = max(bound, float(weight @ need / best[0, capacity]))
            tables = chance.integers(TABLES, size=len(lengths))
            for length, own in zip(lengths[::-1].tolist(), tables):
                short = target * need[length] - cover[length]
                if short <= 0:
                    continue
                filled = _filled(length, first[own], capacity)
                share = short / filled[length]
                chosen[tuple(sorted(filled.items(), reverse=True))] += share
                for item, times in filled.items():
                    cover[item] += share * times
        prior = weight
    return dict(chosen), bound


def whole_packs(
    counts: dict[int, int], chosen: dict[tuple, float], capacity: int = CAPACITY
) -> list[tuple[tuple, int]]:
    """Whole numbers of packs that hold every length exactly as often as it occurs:
    [(((length, times), ...), packs)]."""
    left = {k: n for k, n in counts.items() if n > 0}
    packs: list[tuple[tuple, int]] = []

    def take(config: tuple, most: int) -> None:
        times = min([most, *(left.get(k, 0) // n for k, n in config)])
        if times > 0:
            packs.append((config, times))
            for k, n in config:
                left[k] -= n * times

    ordered = sorted(chosen.items(), key=lambda x: (-x[1], x[0]))
    for config, share in ordered:
        take(config, int(share))
    for config, share in sorted(ordered, key=lambda x: (int(x[1]) - x[1], x[0])):
        if share % 1 >= 0.5:
            take(config, 1)
    return _best_fit(left, packs, capacity)


def _best_fit(
    left: dict[int, int], packs: list[tuple[tuple, int]], capacity: int
) -> list[tuple[tuple, int]]:
    """The rest, longest first, into the packs with the least room that fits, many equal
    packs at a time."""
    by_room: dict[int, list[tuple[tuple, int]]] = defaultdict(list)
    for config, n in packs:
        by_room[capacity - sum(k * times for k, times in config)].append((config, n))
    rooms = sorted(by_room)

    def put(room: int, config: tuple, n: int) -> None:
        if n:
            if not by_room[room]:
                bisect.insort(rooms, room)
            by_room[room].append((config, n))

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                config, there = by_room[room].pop()
                if not by_room[room]:
                    del rooms[at]
            else:
                room, config, there = capacity, (), n
            times = min(room // length, n)
            used = min(there, n // times)
            if config:
                put(room, config, there - used)
            put(room - times * length, (*config, (length, times)), used)
            n -= times * used
    return [x for room in rooms for x in by_room[room]]


def slots(packs: list[tuple[tuple, int]]) -> pd.DataFrame:
    """Where the ranks of a length lie: ``packs`` sequences from ``sequence`` on take the
    ranks from ``rank`` on, ``times`` each, from ``offset`` on. Ordered by ``key``."""
    rows, given, sequence = [], defaultdict(int), 0
    for config, n in packs:
        offset = 0
        for length, times in config:
            rows.append(((length << _RANK_BITS) + given[length], given[length], sequence, n, offset))
            given[length] += times * n
            offset += times * length
        sequence += n
    columns = ["key", "rank", "sequence", "packs", "offset"]
    return pd.DataFrame(rows, columns=columns, dtype="int64").sort_values("key", ignore_index=True)


def _placed(table: pd.DataFrame):
    arrays = {c: table[c].to_numpy() for c in table.columns}

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            at = np.searchsorted(arrays["key"], (length << _RANK_BITS) + rank, "right") - 1
            turn, pack = np.divmod(rank - arrays["rank"][at], arrays["packs"][at])
            yield frame.drop(columns="rank").assign(
                sequence_id=arrays["sequence"][at] + pack, offset=arrays["offset"][at] + turn * length)

    return placed


def pack_few(
    docs: DataFrame, tokenizer_file: str, *, capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(
            _pieces(tokenizer_file, capacity, end),
            "doc_id long, piece int, start long, length long, ids_crc32 long, task long, place long"),
        "pieces")
    # A piece's rank among those of its length: its place after the tasks before its own.
    counted = stage(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = {r[0]: r[1] for r in counted.groupBy("length").agg(F.sum("n")).collect()}  # one row a length
    chosen, _ = configurations(counts, capacity)
    table = slots(whole_packs(counts, chosen, capacity))
    # The offsets grow with the number of tasks, so they are merged and not broadcast.
    ranked = pieces.join(before.hint("merge"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))
    return ranked.mapInPandas(
        _placed(table),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

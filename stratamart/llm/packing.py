"""Sequence packing by shortest-pack-first over the length histogram.

Documents become token ids with an end id each; documents over the capacity are cut
into full pieces and a rest. Lengths are placed longest first: each into the shortest pack (the
one with the most room), or into a new one where it does not fit there, many packs of one
pattern at a time, so the work follows the number of lengths and not of documents.
The patterns are joined back to the pieces by rank: piece number r of its length goes
to the pattern slot that holds rank r.

A null or empty text is its end id alone. Repeated rows and null ids are documents of
their own. The tokenizer's special tokens, written out in a text, are their own ids. No
documents give no rows. Only doc_id and text are read.
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

CAPACITY = 4096
END = 2
# Words whose ids a Python worker remembers, and documents it looks up at a time.
_CACHE = 1_500_000
_TOGETHER = 32
# Letters and digits that ASCII punctuation at a word's end is split off from.
_ENDING = re.compile(r"([0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]+)")
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, place long")


class WordIds(dict):
    """Ids of a word as little-endian bytes, remembered; emptied when it has grown large."""

    def __init__(self, tokenizer_file: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def add(self, words: set[bytes]) -> None:
        new = {w for w in words if w not in self}
        if len(self) + 2 * len(new) > _CACHE:
            self.clear()
            new = words
        # Punctuation after letters is a token of its own in this vocabulary.
        # bytes.lower() changes A-Z only; the vocabulary is lower case anyway.
        # Special tokens are found in words as written.
        lowered = {w: w.lower() for w in new}
        for w in [w for w, low in lowered.items() if any(s in low for s in self.special)]:
            lowered[w] = w
        ends = {}
        for low in set(lowered.values()):
            if low[-1] in _SIGNS and (m := _ENDING.fullmatch(low.decode())):
                ends[low] = m[1].encode(), m[2].encode()
        plain = {low for low in lowered.values() if low not in ends}
        plain.update(part for both in ends.values() for part in both)
        words = [w for w in plain if w not in self]
        texts = [w.decode() for w in words]
        for w, e in zip(words, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            self[w] = array("I", e.ids).tobytes()
        for w, low in lowered.items():
            if low in ends:
                head, tail = ends[low]
                self[w] = self[head] + self[tail]
            elif w is not low:
                self[w] = self[low]


def word_ids(tokenizer_file: str) -> WordIds:
    """This Python worker's memory of word ids: it outlives the task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return worker_memory(("WordIds", tokenizer_file), lambda: WordIds(tokenizer_file))


def token_bytes(texts: list[bytes | None], cache: WordIds) -> list[bytes]:
    """The ids of texts in UTF-8 as unsigned 32-bit little-endian numbers.

    This vocabulary drops white space, and no token crosses it, so that a text's ids
    are those of its words one after another.
    """
    words = [(t or b"").split() for t in texts]
    cache.add(set().union(*words))
    return [b"".join(map(cache.__getitem__, w)) for w in words]


def _pieces(tokenizer_file: str, capacity: int, end: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_ids(tokenizer_file)
        last = array("I", [end]).tobytes()
        part = TaskContext.get().partitionId()
        places: dict[int, int] = defaultdict(int)
        kinds = {k: pa.int64() for k in (
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place")}

        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, _TOGETHER):
                    doc_ids, texts = (c.to_pylist() for c in batch.slice(at, _TOGETHER).columns)
                    for doc_id, ids in zip(doc_ids, token_bytes(texts, cache)):
                        ids += last
                        n = len(ids) // 4
                        for start in range(0, n, capacity):
                            length = min(capacity, n - start)
                            crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                            yield doc_id, start, length, crc, n, part, places[length]
                            places[length] += 1

        return emit(kinds, rows())

    return pieces


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns and how many sequences have each: [([(length, times), ...], count)].

    Lengths longest first; each into the shortest pack, where it fits, or a new one.
    """
    rooms: dict[int, list[list]] = defaultdict(list)  # room left: [pattern, count]
    left_rooms: list[int] = []

    def put(pattern: tuple, room: int, count: int) -> None:
        if not rooms[room]:
            bisect.insort(left_rooms, room)
        rooms[room].append([pattern, count])

    for length in sorted((k for k, n in counts.items() if n > 0), reverse=True):
        left = counts[length]
        while left:
            if not left_rooms or left_rooms[-1] < length:  # new packs, as full as this length gets them
                times = min(left, capacity // length)
                packs = left // times
                put(((length, times),), capacity - length * times, packs)
                left -= packs * times
                continue
            room = left_rooms[-1]
            pattern, count = rooms[room].pop()
            if not rooms[room]:
                left_rooms.pop()
            packs = min(count, left)  # one each: a pack that got one is no longer the shortest
            if packs < count:
                put(pattern, room, count - packs)
            put(pattern + ((length, 1),), room - length, packs)
            left -= packs
    return [(list(p), n) for _, held in sorted(rooms.items()) for p, n in held]


def slot_table(patterns: list[tuple[list[tuple[int, int]], int]]) -> pd.DataFrame:
    """Slots by length and rank: the ranks from ``rank`` on go to ``packs`` sequences
    from ``sequence`` on, ``times`` pieces in each from ``offset`` on."""
    rows, given, sequence = [], defaultdict(int), 0
    for pattern, packs in patterns:
        offset = 0
        for length, times in pattern:
            rows.append((length, given[length], sequence, packs, offset))
            given[length] += times * packs
            offset += length * times
        sequence += packs
    slots = pd.DataFrame(rows, columns=["length", "rank", "sequence", "packs", "offset"], dtype="int64")
    return slots.sort_values(["length", "rank"], ignore_index=True)


def _placed(slots: pd.DataFrame):
    lengths = slots["length"].to_numpy()
    ranks, firsts = slots["rank"].to_numpy(), slots["sequence"].to_numpy()
    packs, offsets = slots["packs"].to_numpy(), slots["offset"].to_numpy()

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = {int(n): np.searchsorted(lengths, [n, n + 1]) for n in np.unique(lengths)}
        for frame in frames:
            rank, length = frame["rank"].to_numpy(), frame["length"].to_numpy()
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                low, high = starts[int(n)]
                at = low + np.searchsorted(ranks[low:high], rank[mine], "right") - 1
                turn, pack = np.divmod(rank[mine] - ranks[at], packs[at])
                sequence[mine] = firsts[at] + pack
                offset[mine] = offsets[at] + turn * n
            yield frame.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    return placed


def pack(
    docs: DataFrame, tokenizer_file: str, *, capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = stage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        .mapInArrow(_pieces(tokenizer_file, capacity, end), _PIECE), "pieces")
    # Counts per task and length; a piece's rank is its place after the tasks before.
    counted = stage(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    histogram = {r[0]: r[1] for r in counted.groupBy("length").agg(F.sum("n")).collect()}  # one row a length
    slots = slot_table(pack_histogram(histogram, capacity))
    ranked = pieces.join(offsets.drop("n"), ["part", "length"])
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return ranked.select(*columns, (F.col("before") + F.col("place")).alias("rank")).mapInPandas(
        _placed(slots),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

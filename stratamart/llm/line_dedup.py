"""Line dedup by two Bloom filters: lines seen once and lines seen twice.

One pass over the documents builds both filters from line-key hashes. Only lines
that the second filter suspects are shuffled, to be counted exactly by their key;
the lines confirmed as repeated are then dropped.

A key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower
case. A key counts once per row of the documents. Rows equal in doc_id and text are
one document in different copies: each counts, and all get the same result.

Null and empty texts are one empty line. Empty keys are never dropped. A document
that loses all lines keeps an empty text. Nothing else of a row is looked at, so
null ids and columns of any other name pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import emit, hot_keys, partitions, spread_join, stage

# Each filter is two bitmaps; a key sets one bit in each of them.
MAPS = 2
CHUNK_BITS = 16
# Bits of one bitmap: 512 for each document, within these bounds. 2**28 bits, the
# most that is broadcast, are 32 MB a bitmap. A filter too small for its input
# suspects more lines; results do not change.
BITS_PER_DOCUMENT = 512
LEAST_BITS, MOST_BITS = 20, 28
SPACE = b" \t\n\x0b\x0c\r"
FLUSH = 4_000_000


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()  # bytes.lower() changes A-Z only


def identity(key: bytes) -> bytes:
    """The key itself, or its SHA-256 where it is longer than that."""
    return key if len(key) < 32 else b"\xff" + hashlib.sha256(key).digest()


def _code_points(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode("utf-8", "replace")) >= least)


def _hashes(least: int):
    """Key hashes of documents, distinct within each."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            found: list[int] = []
            for text in batch.column(0).to_pylist():
                keys = {line_key(x) for x in (text or "").encode().split(b"\n")}
                found += {xxhash.xxh3_64_intdigest(k) for k in keys if _code_points(k, least)}
            yield np.array(found, np.uint64)

    return hashes


def _positions(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return [(hashes >> np.uint64(shift)) & mask for shift in (0, 64 - bits)][:MAPS]


def filter_bits(wanted: int) -> int:
    """Size of a bitmap as a power of two, within the bounds of what is broadcast."""
    return min(MOST_BITS, max(LEAST_BITS, int(np.ceil(np.log2(max(1, wanted))))))


def _sparse(hashes: np.ndarray, bits: int) -> Iterator[tuple]:
    """A task's bits per chunk: positions set at least once, and at least twice."""
    for m, pos in enumerate(_positions(hashes, bits)):
        pos, n = np.unique(pos, return_counts=True)
        chunk = (pos >> np.uint64(CHUNK_BITS)).astype(np.int64)
        low = (pos & np.uint64((1 << CHUNK_BITS) - 1)).astype("<u2")
        ends = np.flatnonzero(np.diff(chunk, append=-1)) + 1
        start = 0
        for end in ends:
            part = slice(start, end)
            yield (
                int(chunk[start]) * MAPS + m,
                low[part].tobytes(),
                low[part][n[part] > 1].tobytes(),
            )
            start = end


def _build(hashes, bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held, n = [], 0
            for found in hashes(batches):
                held.append(found)
                n += len(found)
                if n >= FLUSH:
                    yield from _sparse(np.concatenate(held), bits)
                    held, n = [], 0
            if n:
                yield from _sparse(np.concatenate(held), bits)

        kinds = {"chunk": pa.int64(), "once": pa.binary(), "twice": pa.binary()}
        return emit(kinds, rows(), 4_096)

    return build


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Twice: in one task's second filter, or in two tasks' first filters."""
    seen: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
            counts = seen.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.uint8))
            for found in (once, twice):
                at = np.frombuffer(found, "<u2")
                counts[at] = np.minimum(counts[at] + 1, 2)
    rows = ((c, np.packbits(n > 1).tobytes()) for c, n in seen.items())
    yield from emit({"chunk": pa.int64(), "twice": pa.binary()}, rows, 1_024)


def seen_twice(rows: DataFrame, hashes, bits: int) -> list[np.ndarray]:
    """The second filter over all rows: packed bitmaps of 2**bits bits.

    ``hashes`` turns record batches into arrays of 64-bit hashes, each hash once for
    every document that has it.
    """
    spark = rows.sparkSession
    chunks = 1 << (bits - CHUNK_BITS)
    merged = (
        rows.mapInArrow(_build(hashes, bits), "chunk long, once binary, twice binary")
        .repartition(min(partitions(spark), chunks * MAPS), "chunk")
        .mapInArrow(_merge, "chunk long, twice binary")
    )
    maps = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(MAPS)]
    width = 1 << (CHUNK_BITS - 3)
    for row in merged.toLocalIterator():
        chunk, m = divmod(row["chunk"], MAPS)
        maps[m][chunk * width:(chunk + 1) * width] = np.frombuffer(row["twice"], np.uint8)
    return maps


def suspected(hashes: np.ndarray, maps: list[np.ndarray], bits: int) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for at, bitmap in zip(_positions(hashes, bits), maps):
        found &= (bitmap[(at >> np.uint64(3)).astype(np.int64)]
                  >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1
    return found


def _occurrences(maps, bits: int, least: int):
    """(doc_id, text hash, key) of every suspected key of every document."""

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = maps.value

        def rows():
            for batch in batches:
                for doc_id, mark, text in zip(*(c.to_pylist() for c in batch.columns)):
                    keys = {line_key(x) for x in (text or "").encode().split(b"\n")}
                    keys = [k for k in keys if _code_points(k, least)]
                    hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
                    for i in np.flatnonzero(suspected(hashes, bitmaps, bits)):
                        yield doc_id, mark, identity(keys[i])

        return emit({"doc_id": pa.int64(), "mark": pa.int64(), "key": pa.binary()}, rows())

    return occurrences


_KEPT = "n_lines long, n_dropped long, kept string"


def _without(texts: pd.Series, dropped: pd.Series, owned: pd.Series) -> pd.DataFrame:
    out = []
    for text, keys, own in zip(texts, dropped, owned):
        lines = (text or "").encode().split(b"\n")
        if keys is None or not len(keys):
            out.append((len(lines), 0, text or ""))
            continue
        gone, first = {bytes(k) for k in keys}, {bytes(k) for k in (() if own is None else own)}
        kept = []
        for line in lines:
            key = identity(line_key(line))
            if key in first:
                first.discard(key)
            elif key in gone:
                continue
            kept.append(line)
        out.append((len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
    return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])


def drop_repeated_lines(
    docs: DataFrame, *, min_docs: int = 10, min_key: int = 1, keep_first: bool = False
) -> DataFrame:
    """``docs`` with ``text`` rewritten, and ``_n_lines`` and ``_n_dropped`` added.

    Keys of at least ``min_key`` code points in at least ``min_docs`` documents lose
    all their lines, or, with ``keep_first``, all but the first line in the document
    of the smallest doc_id (then the smallest hash of the text).
    """
    if min_docs < 2 or min_key < 1:
        raise ValueError("min_docs must be at least 2, min_key at least 1")
    spark = docs.sparkSession
    bits = filter_bits(docs.count() * BITS_PER_DOCUMENT)
    maps = spark.sparkContext.broadcast(seen_twice(docs.select("text"), _hashes(min_key), bits))
    mark = F.xxhash64("text")
    found = stage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark.alias("mark"), "text")
        .mapInArrow(_occurrences(maps, bits, min_key), "doc_id long, mark long, key binary"),
        "suspects",
    )
    counts = stage(
        found.groupBy("key").agg(
            F.count("*").alias("n"), F.min(F.struct("doc_id", "mark")).alias("first")
        ).where(F.col("n") >= min_docs),
        "repeated",
    )
    drops = spread_join(
        found, counts.select("key", "first"), "key", hot_keys(counts, "key"),
        F.struct("doc_id", "mark"),
    ).withColumn("own", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark")))
    drops = drops.groupBy("doc_id", "mark").agg(
        F.collect_set("key").alias("_keys"),
        F.collect_set(F.when(F.col("own") & F.lit(keep_first), F.col("key"))).alias("_own"),
    ).withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    # The caller's columns travel in a struct, where their names meet no others.
    held = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"),
        F.col("doc_id").cast("long").alias("_doc_id"), mark.alias("_text_mark"))
    joined = held.join(
        drops, F.col("_doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_mark") == F.col("_mark")), "left")
    done = joined.withColumn("_out", F.pandas_udf(_without, _KEPT)("_doc.text", "_keys", "_own"))
    keep = [F.col("_out.kept").alias("text") if c == "text" else F.col("_doc").getField(c).alias(c)
            for c in docs.columns]
    return done.select(
        *keep, F.col("_out.n_lines").alias("_n_lines"), F.col("_out.n_dropped").alias("_n_dropped")
    )

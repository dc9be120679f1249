"""Removal of repeated byte strings across documents, by sparse suffix sorting.

A byte goes when a string of ``LENGTH`` bytes covers it that also starts in a document with
a smaller doc_id. Sorting every suffix would move a text ``LENGTH`` times over. Instead each
window of ``LENGTH`` bytes has an anchor, the place inside it whose ``GRAM`` bytes have the
least hash: equal windows have equal anchors at equal places, so only suffixes at anchors
are sorted. Two Bloom filters over all anchors, once seen and twice seen, leave the anchors
whose gram other documents may have. An anchor carries the bytes of all windows it stands
for, is dealt to a bucket by the hash of its gram, and inside a bucket the suffixes at equal grams are put in order
deep-shallow. From the common prefixes to the right and classes of equal bytes to the left
every window's class follows, and with it the smallest document that holds the window.

Grams that a sample of documents shows to be frequent are dealt over salts by document.
There a window may have its smallest document under another salt: windows that are not yet
repeated under their own salt go on, at most once per salt and class, to be compared by
their bytes' hash. The sample decides balance, never the result.

The filters are of bounded size; over-full ones let more anchors through and change nothing
else.

Texts are UTF-8 bytes; a null text is empty. Matches never cross documents and are judged on
the input. Rows with a null doc_id have no order and lose nothing; rows that share a doc_id
are not smaller than one another, and are told apart by their texts. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import emit, hot_keys, partitions, stage
from stratamart.llm.deep_shallow import order_groups
from stratamart.llm.line_dedup import filter_bits, seen_twice, suspected

LENGTH, GRAM = 50, 20
# Text bytes that one bucket of anchors stands for, and text that is cut up at a time.
BUCKET_BYTES = 6_000_000
TOGETHER = 2_500_000
# A gram is frequent from this share of the sampled anchors on: at most 65,536 are sent out.
HOT_SHARE, SAMPLED, LEAST_SEEN = 1 / 65_536, 16, 8
SALTS, DOCUMENTS_A_SALT = 32, 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hashes of all grams, doubling the length covered."""
    powers = {1: _BASE}
    covered, h = 1, raw.astype(np.uint64) + np.uint64(1)
    kept = {1: h}
    with np.errstate(over="ignore"):
        while covered * 2 <= gram:
            n = len(h) - covered
            h = h[:n] * powers[covered] + h[covered:covered + n]
            powers[covered * 2] = powers[covered] * powers[covered]
            covered *= 2
            kept[covered] = h
        total, rest = kept[covered], gram - covered
        while rest:
            step = 1 << (rest.bit_length() - 1)
            more = kept[step]
            n = len(more) - covered
            total = total[:n] * powers[step] + more[covered:covered + n]
            covered, rest = covered + step, rest - step
        total = (total ^ (total >> np.uint64(31))) * _MIX
    return total ^ (total >> np.uint64(29))


def _window_anchors(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least hash of every ``width`` hashes in a row."""
    at, covered = np.arange(len(h), dtype=np.int64), 1
    while covered < width:
        step = min(covered, width - covered)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(h[right] < h[left], right, left)
        covered += step
    return at


def cut_anchors(raw: bytes, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of documents written one after another, ``ends`` after each.

    Returns (document, hash, anchor, first window, last window), places within ``raw``.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(raw) < length:
        return none
    h = _gram_hashes(np.frombuffer(raw, np.uint8), gram)
    anchor = _window_anchors(h, length - gram + 1)
    n = len(raw) - length + 1
    doc = np.searchsorted(ends, np.arange(n), "right")
    valid = np.arange(n) + length <= ends[doc]
    code = np.where(valid, anchor[:n], -1)
    new = np.flatnonzero(np.diff(code, prepend=-2))
    last = np.append(new[1:], n) - 1
    keep = code[new] >= 0
    first, last = new[keep], last[keep]
    at = code[first]
    return doc[first], h[at].view(np.int64), at, first, last


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Documents with an id, about ``TOGETHER`` bytes at a time: ids, marks, texts, ends."""
    ids, marks, texts, size = [], [], [], 0
    for batch in batches:
        for doc_id, mark, text in zip(*(c.to_pylist() for c in batch.columns)):
            if doc_id is None or not text:
                continue
            ids.append(doc_id)
            marks.append(mark)
            texts.append(text.encode())
            size += len(texts[-1])
            if size >= TOGETHER:
                yield np.array(ids), np.array(marks), texts, np.cumsum([len(t) for t in texts])
                ids, marks, texts, size = [], [], [], 0
    if ids:
        yield np.array(ids), np.array(marks), texts, np.cumsum([len(t) for t in texts])


def _grams(length: int, gram: int):
    """Each document's distinct anchor hashes."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts, ends in _batches(batches):
            doc, h, *_ = cut_anchors(b"".join(texts), ends, length, gram)
            pairs = pd.DataFrame({"doc": doc, "gram": h}).drop_duplicates()
            yield pa.RecordBatch.from_arrays([pa.array(pairs["gram"].to_numpy())], names=["gram"])

    return grams


def _distinct(length: int, gram: int):
    """Anchor hashes, each once for a document."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, _, texts, ends in _batches(batches):
            doc, h, *_ = cut_anchors(b"".join(texts), ends, length, gram)
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            new = (np.diff(doc, prepend=-1) != 0) | (np.diff(h, prepend=0) != 0)
            yield h[new].view(np.uint64)

    return distinct


def _dealt(length: int, gram: int, buckets: int, hot, salts: int, maps, bits: int):
    """(bucket, block): the suspected anchors of some documents that go to one bucket."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        frequent = hot.value

        def rows():
            for ids, marks, texts, ends in _batches(batches):
                raw = b"".join(texts)
                anchors = cut_anchors(raw, ends, length, gram)
                known = suspected(anchors[1].view(np.uint64), maps.value, bits)
                doc, h, at, first, last = (f[known] for f in anchors)
                if not len(doc):
                    continue
                salted = np.isin(h, frequent)
                with np.errstate(over="ignore"):
                    salt = (ids[doc].astype(np.uint64) * _MIX) >> np.uint64(33)
                    salt = np.where(salted, salt % np.uint64(salts) + np.uint64(1), np.uint64(0))
                    key = (h.view(np.uint64) ^ (salt * _BASE)) * _MIX
                bucket = (key >> np.uint64(32)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
                starts = np.r_[0, ends[:-1]]
                whole = np.frombuffer(raw, np.uint8)
                for low, high in zip(bounds[:-1], bounds[1:]):
                    mine = order[low:high]
                    size = last[mine] - first[mine] + length
                    offset = np.cumsum(size) - size
                    bytes_at = np.repeat(first[mine] - offset, size) + np.arange(size.sum())
                    fields = (
                        key[mine], ids[doc[mine]].astype(np.int64), marks[doc[mine]].astype(np.int64),
                        (first[mine] - starts[doc[mine]]).astype(np.int64),
                        (at[mine] - first[mine]).astype(np.uint8), (last[mine] - first[mine]).astype(np.uint8),
                        salted[mine].astype(np.uint8), whole[bytes_at])
                    block = len(mine).to_bytes(8, "little") + b"".join(np.ascontiguousarray(f).tobytes() for f in fields)
                    yield int(bucket[mine[0]]), squeeze.compress(block)

        return emit({"bucket": pa.int64(), "block": pa.binary()}, rows(), 512)

    return dealt


def _opened(blocks, length: int) -> tuple[np.ndarray, ...]:
    """The anchors of a bucket; the last field holds each one's bytes from its first window."""
    open_ = zstandard.ZstdDecompressor()
    fields: list[list[np.ndarray]] = [[] for _ in range(7)]
    texts, spread = [], 0
    offsets = []
    for block in blocks:
        raw = open_.decompress(bytes(block))
        n, at = int.from_bytes(raw[:8], "little"), 8
        for k, kind in enumerate((np.uint64, np.int64, np.int64, np.int64, np.uint8, np.uint8, np.uint8)):
            size = n * np.dtype(kind).itemsize
            fields[k].append(np.frombuffer(raw[at:at + size], kind))
            at += size
        text = np.frombuffer(raw[at:], np.uint8)
        size = fields[5][-1].astype(np.int64) + length
        offsets.append(np.cumsum(size) - size + spread)
        texts.append(text)
        spread += len(text)
    return (*(np.concatenate(f) for f in fields), np.concatenate(offsets), np.concatenate(texts))


def repeated_windows(anchors: tuple, length: int, gram: int):
    """(doc, mark, from, to, hash): removed stretches, hash null; open windows with their hash."""
    key, doc, mark, first, left, span, salted, offset, text = anchors
    reach = length - gram
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.diff(key[order], prepend=key[order][:1] ^ np.uint64(1)))
    sizes = np.diff(np.append(new, len(order)))
    ordered = doc[order]
    several = np.minimum.reduceat(ordered, new) != np.maximum.reduceat(ordered, new)
    keep = np.repeat(several | (salted[order][new] == 1), sizes)
    order, group = order[keep], np.repeat(np.arange(len(new)), sizes)[keep]
    if not len(order):
        return []
    doc, mark, first, left, span, salted, offset = (
        f[order].astype(np.int64) for f in (doc, mark, first, left, span, salted, offset))
    padded = np.r_[np.zeros(reach, np.uint8), text, np.zeros(length, np.uint8)]
    anchor = offset + left + reach
    end = offset + span + length + reach  # after the last byte that is this anchor's
    right = np.zeros((len(order), length), np.uint8)
    for j in range(length):
        right[:, j] = np.where(anchor + j < end, padded[anchor + j], 0)
    suffix_order, common = order_groups(right, group)
    place = np.empty(len(order), np.int64)
    place[suffix_order] = np.arange(len(order))
    repeated = np.zeros((len(order), reach + 1), bool)
    undecided: list[tuple] = []
    to_left = group.astype(np.uint64)
    power = _BASE ** np.arange(length, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for r in range(reach + 1):
            if r:
                to_left = (to_left + padded[anchor - r] + np.uint64(1)) * _MIX
                to_left ^= to_left >> np.uint64(29)
            mine = np.flatnonzero((left - span <= r) & (r <= left))
            if not len(mine):
                continue
            to_right = np.cumsum(common < length - r)[place[mine]].astype(np.uint64)
            both = (to_left[mine] ^ (to_right * _BASE)) * _MIX
            inner = np.argsort(both, kind="stable")
            rows = mine[inner]
            starts = np.flatnonzero(np.diff(both[inner], prepend=both[inner][:1] ^ np.uint64(1)))
            least = np.minimum.reduceat(doc[rows], starts)
            least = np.repeat(least, np.diff(np.append(starts, len(rows))))
            gone = doc[rows] > least
            repeated[rows[gone], r] = True
            rest = rows[~gone & (salted[rows] == 1)]
            if len(rest):
                window = (anchor[rest] - r)[:, None] + np.arange(length)
                whole = ((padded[window].astype(np.uint64) + np.uint64(1)) * power).sum(axis=1, dtype=np.uint64)
                whole = (whole ^ (whole >> np.uint64(31))) * _MIX
                at = first[rest] + left[rest] - r
                undecided.append((doc[rest], mark[rest], at, at + length, whole.view(np.int64)))
    # Windows at distance r start r before the anchor: runs of r are stretches.
    edges = np.diff(np.pad(repeated, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(edges == 1)
    _, high = np.nonzero(edges == -1)
    at = first[row] + left[row]
    out = [(doc[row], mark[row], at - (high - 1), at - low + length, None)]
    return out + undecided


def _resolved(length: int, gram: int):
    def resolved(group: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc", "mark", "low", "high", "window"]
        parts = []
        for doc, mark, low, high, window in repeated_windows(
            _opened(group["block"], length), length, gram
        ):
            parts.append(pd.DataFrame({
                "doc": doc, "mark": mark, "low": low, "high": high,
                "window": pd.array([None] * len(doc) if window is None else window, dtype="Int64")}))
        return pd.concat(parts) if parts else pd.DataFrame({c: pd.array([], dtype="Int64") for c in columns})

    return resolved


def merged(stretches) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by stretches."""
    out: list[list[int]] = []
    for low, high in sorted((int(s["low"]), int(s["high"])) for s in stretches):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


_KEPT = "n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _without(texts: pd.Series, stretches: pd.Series) -> pd.DataFrame:
    out = []
    for text, found in zip(texts, stretches):
        raw = (text or "").encode()
        runs = [] if found is None else merged(found)
        kept, at = [], 0
        for low, high in runs:
            kept.append(raw[at:low])
            at = high
        rest = b"".join([*kept, raw[at:]])
        out.append((len(raw), len(raw) - len(rest), len(runs), rest, hashlib.sha256(rest).hexdigest()))
    return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256."""
    if not 8 <= gram < length <= 200:
        raise ValueError("gram must be at least 8 and less than length, length at most 200")
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    size = base.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    buckets = max(partitions(spark), -(-(size[0] or 0) // BUCKET_BYTES))
    salts = max(SALTS, size[1] // DOCUMENTS_A_SALT)
    sample = base.where(F.pmod(F.xxhash64("doc_id", "mark"), F.lit(SAMPLED)) == 0)
    seen = stage(
        sample.mapInArrow(_grams(length, gram), "gram long").groupBy("gram").agg(F.count("*").alias("n"))
        .where(F.col("n") >= LEAST_SEEN), "grams")
    frequent = hot_keys(seen, "gram", share=HOT_SHARE)
    hot = spark.sparkContext.broadcast(np.array(sorted(frequent), np.int64))
    bits = filter_bits((size[0] or 0) // 3)  # some six bits for each anchor
    maps = spark.sparkContext.broadcast(seen_twice(base, _distinct(length, gram), bits))
    found = stage(
        base.mapInArrow(_dealt(length, gram, buckets, hot, salts, maps, bits), "bucket long, block binary")
        .groupBy("bucket").applyInPandas(
            _resolved(length, gram), "doc long, mark long, low long, high long, window long"), "stretches")
    sure = found.where("window IS NULL").select("doc", "mark", "low", "high")
    # At most one document per salt and class is still open, so these groups are small.
    least = F.min("doc").over(Window.partitionBy("window"))
    late = found.where("window IS NOT NULL").withColumn("least", least).where("doc > least")
    runs = sure.unionByName(late.select("doc", "mark", "low", "high")).groupBy("doc", "mark").agg(
        F.collect_list(F.struct("low", "high")).alias("_runs")).withColumnRenamed("mark", "_mark")
    joined = base.join(
        runs.hint("shuffle_hash"), (F.col("doc_id") == F.col("doc")) & (F.col("mark") == F.col("_mark")), "left")
    return joined.withColumn("_out", F.pandas_udf(_without, _KEPT)("text", "_runs")).select("doc_id", "_out.*")

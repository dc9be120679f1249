"""Vector codes: every vector's parts as numbers of codebook entries, found by LAESA.

Components become integers, vectors are cut into equal parts, and each part position has
a codebook, refined by a fixed number of rounds: assign every part to its nearest entry,
replace every entry by the floored mean of its parts. All distances are exact integers.

LAESA saves most of them. Some of the first entries stay fixed as pivots; each part's
distances to them are computed once and written with the part. Every round computes the
few distances between pivots and entries. By the triangle inequality the difference of
the two is a lower bound of the distance between part and entry: entries are tried in
the order of their bounds, and an entry whose bound is above the best exact distance so
far, by more than what rounding could do, is never evaluated.

Rows without a vector, or with a null or non-finite component, are left out. Vectors of
unequal lengths are extended by zeros to the longest, and that to a multiple of the number
of parts. Scaled components beyond ``limit_of`` (some 46,000 before scaling, with 64
components) count as that limit, so that no distance leaves 64 bits. Equal ids, null ids
(they come last) and repeated rows are vectors of their own; the first entries among equal
ids are settled by their components. With fewer vectors than entries there are as many
entries as vectors. Ties go to the lower index, so of equal entries the first takes all. An
empty table has no rows. Null labels are one label. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import hot_keys, spread_join, stage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
PIVOTS = 4
# Parts whose distances are looked at together, in one task.
_TOGETHER = 8_192
# Relative error allowed for in pivot distances kept as 32-bit floats.
_SLACK = 1e-5


def limit_of(size: int) -> int:
    """Largest component for which squared distances of ``size`` components stay in 63 bits."""
    return math.isqrt((2**63 - 1) // max(size, 1)) // 2


def squared(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    apart = parts - entries
    return np.einsum("ij,ij->i", apart, apart)


def choose_pivots(entries: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """The first entry, then always the one whose distances to those chosen sum to most."""
    far = np.sqrt(((entries[:, None] - entries[None]).astype(float) ** 2).sum(axis=2))
    chosen = [0]
    while len(chosen) < min(pivots, len(entries)):
        total = far[chosen].sum(axis=0)
        total[chosen] = -1
        chosen.append(int(total.argmax()))
    return entries[chosen]


def to_pivots(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of parts (rows) to pivots (columns)."""
    return np.stack([np.sqrt(squared(parts, p).astype(float)) for p in pivots], axis=1)


def assign(
    parts: np.ndarray, away: np.ndarray, entries: np.ndarray, entry_away: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry and its exact squared distance, for every part; evaluations made.

    ``away`` and ``entry_away`` are distances to the pivots, of parts and of entries.
    """
    n = len(parts)
    bounds = np.zeros((n, len(entries)))
    for pivot in range(away.shape[1]):
        own, other = away[:, pivot, None], entry_away[None, :, pivot]
        np.maximum(bounds, np.abs(own - other) - _SLACK * (own + other + 1), out=bounds)
    order = np.argsort(bounds, axis=1, kind="stable")
    sorted_bounds = np.take_along_axis(bounds, order, axis=1)
    nearest = order[:, 0].copy()
    best = squared(parts, entries[nearest])
    evaluated, alive = n, np.arange(n)
    for rank in range(1, len(entries)):
        # Bounds only rise from here on, so a row that stops is done.
        alive = alive[sorted_bounds[alive, rank] <= np.sqrt(best[alive].astype(float)) * (1 + _SLACK)]
        if not len(alive):
            break
        entry = order[alive, rank]
        found = squared(parts[alive], entries[entry])
        evaluated += len(alive)
        better = (found < best[alive]) | ((found == best[alive]) & (entry < nearest[alive]))
        best[alive[better]], nearest[alive[better]] = found[better], entry[better]
    return nearest, best, evaluated


class Codebooks:
    """Entries by part position, as a (parts, entries, components of a part) array, with pivots."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray) -> None:
        self.entries, self.pivots = entries, pivots
        self.away = np.stack([to_pivots(e, p) for e, p in zip(entries, pivots)])

    def assigned(self, parts: np.ndarray, away: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and squared distances of vectors cut into (vectors, parts, components)."""
        found = [
            assign(parts[:, at], away[:, at], self.entries[at], self.away[at])
            for at in range(len(self.entries))
        ]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _matrix(column: pa.Array, shape: tuple[int, ...]) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    wide = np.int64 if flat.dtype.kind == "i" else np.float64
    return flat.astype(wide).reshape(len(column), *shape)


def _scaled(vector: Column, size: int) -> Column:
    """Floored integer components, extended by zeros to ``size``."""
    limit = float(limit_of(size))
    whole = F.transform(
        vector, lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(limit)), F.lit(-limit))).cast("int"))
    return F.slice(F.concat(whole, F.array_repeat(F.lit(0), size)), 1, size)


def _with_pivots(pivots: np.ndarray):
    shape = (len(pivots), pivots.shape[2])

    def away(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TOGETHER):
                cut = batch.slice(at, _TOGETHER)
                parts = _matrix(cut.column("_v"), shape)
                far = np.stack([to_pivots(parts[:, i], p) for i, p in enumerate(pivots)], axis=1)
                width = far.shape[1] * far.shape[2]
                ends = pa.array(np.arange(0, len(parts) * width + 1, width), pa.int32())
                far = pa.ListArray.from_arrays(ends, pa.array(far.ravel().astype(np.float32)))
                yield pa.RecordBatch.from_arrays([*cut.columns, far], names=[*cut.schema.names, "_away"])

    return away


def _sums(books: Codebooks):
    """Each task's counts and component sums: one row per part position, entry, component."""
    places, n_entries, size = books.entries.shape
    shape, n_pivots = (places, size), books.pivots.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((places, n_entries, size), np.int64)
        count = np.zeros((places, n_entries), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _TOGETHER):
                cut = batch.slice(at, _TOGETHER)
                parts = _matrix(cut.column("_v"), shape)
                away = _matrix(cut.column("_away"), (places, n_pivots))
                codes, _ = books.assigned(parts, away)
                for place in range(places):
                    member = codes[:, place, None] == np.arange(n_entries)
                    total[place] += member.T.astype(np.int64) @ parts[:, place]
                    count[place] += member.sum(axis=0)
        place, entry, component = (x.ravel() for x in np.indices(total.shape))
        used = count[place, entry] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[used].astype(np.int64))
             for x in (place, entry, component, total.ravel(), count[place, entry])],
            names=["place", "entry", "component", "total", "n"])

    return sums


def _refined(parts: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round. One number per component of an entry comes back."""
    found = (
        parts.select("_v", "_away")
        .mapInArrow(_sums(books), "place long, entry long, component long, total long, n long")
        .groupBy("place", "entry", "component")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        .collect()
    )
    entries = books.entries.copy()
    for place, entry, component, total, n in found:
        entries[place, entry, component] = int(total) // n
    return Codebooks(entries, books.pivots)


def _coded(books: Codebooks):
    places, _, size = books.entries.shape
    shape, n_pivots = (places, size), books.pivots.shape[1]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TOGETHER):
                cut = batch.slice(at, _TOGETHER)
                codes, errors = books.assigned(
                    _matrix(cut.column("_v"), shape), _matrix(cut.column("_away"), (places, n_pivots)))
                yield pa.RecordBatch.from_arrays(
                    [cut.column("vec_id"), cut.column("label"),
                     pa.array([row.tobytes().hex() for row in codes.astype(np.uint8)]),
                     pa.array(errors.sum(axis=1))],
                    names=["vec_id", "label", "code", "error"])

    return coded


def _cleaned(vectors: DataFrame, vector: str) -> DataFrame:
    kept = vectors.select("vec_id", "label", F.col(vector).cast("array<double>").alias("_v")).where(
        F.col("_v").isNotNull()
        & F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return kept


def encode(
    vectors: DataFrame, *, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS, pivots: int = PIVOTS,
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256), one row per kept vector.

    ``entries`` is at most 256, as a code holds two hex digits per part.
    """
    kept = _cleaned(vectors, vector)
    longest = kept.agg(F.max(F.size("_v"))).first()[0] or 0
    size = max(1, -(-longest // parts)) * parts
    whole = kept.withColumn("_v", _scaled(F.col("_v"), size))
    first = whole.orderBy(F.asc_nulls_last("vec_id"), "_v").limit(entries).select("_v").collect()
    if not first:
        return whole.selectExpr(
            "vec_id", "label", "CAST(NULL AS string) AS code", "0L AS error", "0L AS label_error",
            "CAST(NULL AS string) AS codebooks_sha256")
    start = np.array([r[0] for r in first], np.int64).reshape(len(first), parts, size // parts)
    start = np.ascontiguousarray(start.transpose(1, 0, 2))
    books = Codebooks(start, np.stack([choose_pivots(e, pivots) for e in start]))
    named = [f for f in whole.schema.fields if f.name in ("vec_id", "label")]
    plain = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named)
    prepared = stage(
        whole.mapInArrow(_with_pivots(books.pivots), f"{plain}, _v array<int>, _away array<float>"), "parts")
    for _ in range(rounds):
        books = _refined(prepared, books)
    coded = stage(prepared.mapInArrow(_coded(books), f"{plain}, code string, error long"), "codes")
    return _with_label_error(coded).withColumn("codebooks_sha256", F.lit(books.sha256()))


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Add each label's sum of errors; a sum beyond 64 bits counts as the largest number."""
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    keyed = coded.withColumn("_key", key)
    totals = stage(
        keyed.groupBy("_key").agg(
            F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"), F.count("*").alias("n")), "labels")
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = totals.select("_key", F.least("_sum", most).cast("long").alias("label_error"))
    joined = spread_join(keyed, sums, "_key", hot_keys(totals, "_key"), F.struct("vec_id", "code"))
    return joined.select("vec_id", "label", "code", "error", "label_error")

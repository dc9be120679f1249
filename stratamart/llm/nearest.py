"""Approximate nearest neighbours by adaptive dimension scan within inverted lists.

Largest inner product becomes least distance by one more dimension, which gives all
vectors the same length, and a query is brought to that length as well, which changes no
order. Vectors are rotated at random and dealt to lists by their nearest centroid. A query
probes its nearest lists. Inside a list the distance to all vectors grows by blocks of
rotated dimensions; after each block a hypothesis test on the partial distance abandons the
vectors that are, with high confidence, farther than the query's k-th so far. What is left
gets its exact inner product on the original vectors.

Centroids are fitted on a bounded sample; every vector is indexed. How many lists a query
probes is measured: the true neighbours of ``CHECKED`` queries are found among all vectors in
blocks, and as many lists are probed as hold ``FOUND`` of them, all lists if need be. Vectors
much longer than nearly all others (at most one in a thousand) would leave the others a
distance of nothing but that length; they form a list of their own that every query goes
through in full. Lists of many vectors, and the queries that probe one list, are dealt into
blocks of bounded size.

Vectors that are null, zero, of another length than most, or hold null or non-finite
values take no part, and neither do rows without an id. Rows that share a query's id are
the query itself. Equal inner products rank by id; repeated rows are found as often as they
are there. Other columns are not read. Without vectors or queries there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import stage

# Vectors the centroids are fitted on, and lists, at most; lists a query probes, at least.
SAMPLE = 20_000
MOST_LISTS = 1_024
LEAST_PROBES = 16
# Queries whose true neighbours decide the number of probes, and the share of those to be met.
CHECKED, FOUND = 256, 0.97
# Long is a vector beyond this times the length that all but one in a thousand keep to.
STRETCH, USUAL = 1.25, 0.999
# Vectors and queries that one call holds.
LIST_BLOCK, QUERY_BLOCK = 8_192, 1_024
COLUMNS = 16
CONFIDENCE = 2.1


def _rotation(width: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(9).normal(size=(width, width)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _norms(x: np.ndarray) -> np.ndarray:
    """Lengths, also of vectors whose squares are no numbers any more."""
    most = np.abs(x).max(axis=1)
    with np.errstate(over="ignore"):
        return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))


def _lengthened(x: np.ndarray, length: float) -> np.ndarray:
    """Vectors as parts of ``length``, with one more dimension that makes it up to 1."""
    part = x / length
    rest = np.sqrt(np.maximum(0.0, 1 - (part * part).sum(axis=1)))
    return np.hstack([part, rest[:, None]]).astype(np.float32)


def _directions(x: np.ndarray) -> np.ndarray:
    """Queries at length 1, with the further dimension empty."""
    part = x / np.abs(x).max(axis=1, keepdims=True)
    part /= np.sqrt((part * part).sum(axis=1, keepdims=True))
    return np.hstack([part, np.zeros((len(x), 1))]).astype(np.float32)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ y.T + (y * y).sum(axis=1)


def centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Plain k-means; an empty list is moved to the vector farthest from its own."""
    draw = np.random.default_rng(3)
    centres = sample[np.sort(draw.choice(len(sample), min(lists, len(sample)), replace=False))].copy()
    for _ in range(rounds):
        d = _distances(sample, centres)
        own = d.argmin(axis=1)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres, dtype=np.float64)
        np.add.at(sums, own, sample)
        filled = counts > 0
        centres[filled] = (sums[filled] / counts[filled, None]).astype(np.float32)
        far = np.argsort(-d[np.arange(len(own)), own])
        for place, i in zip(np.flatnonzero(~filled), far):
            centres[place] = sample[i]
    return centres


def _matrix(column) -> np.ndarray:
    raw = b"".join(column)
    return np.frombuffer(raw, np.float64).reshape(len(column), -1)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.array(batch.column(1).to_pylist(), np.float64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(_norms(x))],
            names=["vec_id", "vector", "norm"])


def _assigned(shared, length: float):
    """Every vector with its list; the list after the last centroid's holds the long ones."""
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, rotation = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            long = batch.column(2).to_numpy() > length
            near = np.where(long[:, None], 0.0, _matrix(batch.column(1).to_pylist()))
            x = _lengthened(near, length) @ rotation
            own = np.where(long, len(centres), _distances(x, centres).argmin(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.array(own.astype(np.int64))],
                names=["vec_id", "vector", "rotated", "list"])

    return assigned


def _true_lists(shared, k: int):
    """Lists of the k vectors with the largest products with each checked query, within a task."""
    def true_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value
        score = np.full((len(ids), 0), -np.inf)
        place = np.zeros((len(ids), 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                product = queries @ _matrix(batch.column(1).to_pylist()).T
            product[np.isnan(product) | (ids[:, None] == batch.column(0).to_numpy())] = -np.inf
            score = np.hstack([score, product])
            place = np.hstack([place, np.broadcast_to(batch.column(2).to_numpy(), product.shape)])
            if score.shape[1] > k:
                best = np.argpartition(-score, k - 1, axis=1)[:, :k]
                score, place = np.take_along_axis(score, best, 1), np.take_along_axis(place, best, 1)
        query, at = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query.astype(np.int32)), pa.array(score[query, at]), pa.array(place[query, at])],
            names=["query", "score", "list"])

    return true_lists


def probes_needed(indexed: DataFrame, asked: DataFrame, centres: np.ndarray, rotation: np.ndarray, k: int) -> int:
    """Nearest lists that together hold the share ``FOUND`` of the checked queries' neighbours."""
    least = min(LEAST_PROBES, len(centres))
    checked = asked.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(CHECKED).collect()
    if not checked:
        return least
    queries = _matrix([bytes(r["vector"]) for r in checked])
    shared = asked.sparkSession.sparkContext.broadcast(
        (np.array([r["vec_id"] for r in checked], np.int64), queries))
    near = indexed.where(F.col("list") < len(centres)).select("vec_id", "vector", "list").mapInArrow(
        _true_lists(shared, k), "query int, score double, list long")
    window = Window.partitionBy("query").orderBy(F.desc("score"), "list")
    met = near.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).select(
        "query", "list").collect()  # k rows a checked query
    if not met:
        return least
    order = np.argsort(_distances(_directions(queries) @ rotation, centres), axis=1, kind="stable")
    turn = np.argsort(order, axis=1)
    turns = np.sort([turn[r["query"], r["list"]] for r in met])
    return max(least, int(turns[int(np.ceil(FOUND * len(turns))) - 1]) + 1)


def _probing(shared, sizes: np.ndarray, probes: int, k: int):
    """A query's lists: ``probes``, or as many as hold more than k vectors, and that of the long ones."""

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, rotation = shared.value
        last = [len(centres)] if sizes[len(centres)] else []
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _directions(_matrix(batch.column(1).to_pylist())) @ rotation
            order = np.argsort(_distances(x, centres), axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            need = np.maximum(probes, (held <= k).sum(axis=1) + 1)
            lists = [np.concatenate([o[:n], last]) for o, n in zip(order, need)]
            at = np.repeat(np.arange(len(x)), [len(p) for p in lists])
            rows = [r.tobytes() for r in x]
            ids, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in at], pa.int64()), pa.array([vectors[i] for i in at], pa.binary()),
                 pa.array([rows[i] for i in at], pa.binary()), pa.array(np.concatenate(lists).astype(np.int64))],
                names=["query_id", "query", "turned", "list"])

    return probing


def scan(q: np.ndarray, x: np.ndarray, k: int, columns: int = COLUMNS, confidence: float = CONFIDENCE) -> np.ndarray:
    """Rows of ``x`` that may be among the k nearest of ``q``; the others were abandoned."""
    n, width = x.shape
    if n <= 2 * k:
        return np.arange(n)
    first = max(2 * k, min(n, 4 * k))
    bound = np.partition(((x[:first] - q) ** 2).sum(axis=1), k - 1)[k - 1]
    alive, partial = np.arange(n), np.zeros(n, np.float32)
    for start in range(0, width, columns):
        end = min(width, start + columns)
        partial = partial + ((x[alive, start:end] - q[start:end]) ** 2).sum(axis=1)
        slack = 1 + confidence / np.sqrt(end) if end < width else 1.0
        keep = partial * (width / end) <= bound * slack**2 * (1 + 1e-5)
        alive, partial = alive[keep], partial[keep]
    return alive


def _search(k: int, long_list: int):
    def search(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(vectors) or not len(queries):
            return pd.DataFrame({c: [] for c in columns})
        width = len(vectors["rotated"].iloc[0]) // 4
        x = np.frombuffer(b"".join(vectors["rotated"]), np.float32).reshape(-1, width)
        own = _matrix(vectors["vector"])
        ids = vectors["vec_id"].to_numpy()
        parts = []
        for query_id, query, turned in zip(queries["query_id"], queries["query"], queries["turned"]):
            at = np.arange(len(x)) if key[0] == long_list else scan(np.frombuffer(turned, np.float32), x, k + 1)
            at = at[ids[at] != query_id]
            with np.errstate(over="ignore", invalid="ignore"):
                score = own[at] @ np.frombuffer(query, np.float64)
            best = np.lexsort((ids[at], -score))[:k]
            parts.append((np.full(len(best), query_id), ids[at][best], score[best]))
        return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*parts)))))

    return search


def nearest(table: DataFrame, *, every: int = 20, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row whose id ``every`` divides."""
    vector = F.col("embedding").cast("array<double>")
    valid = F.coalesce(
        F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(vector, lambda v: v != 0), F.lit(False))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("v")).where(
        F.col("vec_id").isNotNull() & valid.alias("valid"))
    widths = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if widths is None:
        return table.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("v") == widths["width"])
    packed = stage(rows.mapInArrow(_pack, "vec_id long, vector binary, norm double"), "vectors")
    usual, longest = packed.agg(F.percentile_approx("norm", USUAL, 10_000), F.max("norm")).first()
    length = min(longest, STRETCH * usual)
    indexable = packed.where(F.col("norm") <= length)
    total = indexable.count()
    sample = _matrix([bytes(r[0]) for r in indexable.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE)
                      .select("vector").collect()])
    rotation = _rotation(widths["width"] + 1)
    lists = int(min(MOST_LISTS, max(1, total**0.5 / 2)))
    centres = centroids(_lengthened(sample, length) @ rotation, lists)
    context = table.sparkSession.sparkContext
    shared = context.broadcast((centres, rotation))
    indexed = stage(packed.mapInArrow(
        _assigned(shared, length), "vec_id long, vector binary, rotated binary, list long"), "index")
    sizes = np.zeros(len(centres) + 1, np.int64)
    for r in indexed.groupBy("list").count().collect():  # one row a list
        sizes[r["list"]] = r["count"]
    queries = packed.where(F.col("vec_id") % every == 0).select("vec_id", "vector")
    probes = probes_needed(indexed, queries, centres, rotation, k)
    asked = stage(queries.mapInArrow(
        _probing(shared, sizes, probes, k), "query_id long, query binary, turned binary, list long"), "queries")
    blocks = {i: max(1, -(-int(n) // LIST_BLOCK)) for i, n in enumerate(sizes)}
    asked_of = {r["list"]: r["count"] for r in asked.groupBy("list").count().collect()}
    parts = {i: max(1, -(-int(asked_of.get(i, 0)) // QUERY_BLOCK)) for i in blocks}

    def of(numbers: dict):  # a number for each list, by its place
        return F.element_at(F.array(*[F.lit(numbers[i]) for i in range(len(numbers))]), (F.col("list") + 1).cast("int"))

    def every_number(numbers: dict):
        return F.explode(F.sequence(F.lit(0), of(numbers) - 1))

    left = indexed.withColumn("block", F.pmod(F.xxhash64("vec_id"), of(blocks)).cast("int")).withColumn(
        "part", every_number(parts))
    right = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), of(parts)).cast("int")).withColumn(
        "block", every_number(blocks))
    keys = ["list", "block", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _search(k, len(centres)), "query_id long, vec_id long, score double")
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

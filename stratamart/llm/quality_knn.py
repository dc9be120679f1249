"""Document quality by nearest-neighbour voting in a latent-semantic space.

A document's terms are its byte pairs, folded into a fixed number of buckets, and the
shares of words equal to the word before and of lines equal to an earlier line, each as
a group of terms so that it counts as much as many pairs do. Terms are weighed by log
frequency and inverse document frequency. Latent vectors are their
projections on the leading singular vectors of a bounded labelled sample. The labelled
vectors are broadcast; every document gets its exact cosine with all of them, block by
block, and its nearest neighbours vote for their labels with their similarity as weight.

Whole texts count. A null or empty text, or one byte long, has no terms and gets score
0. If the sample lacks one of the labels, every score is the share of the other (0.5
for an empty sample). Other columns and repeated rows pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from stratamart.llm.common import emit
from stratamart.llm.labelled import fold, labelled_sample

# Labelled documents of either label that are broadcast, at most.
PER_CLASS = 800
PAIRS = 4_096
# Terms that stand for repeated words, and as many for repeated lines.
REPEATS = 48
TERMS = PAIRS + 2 * REPEATS
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 8.0
BLOCK = 256


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    base: float


def term_counts(text: str | None) -> np.ndarray:
    whole = (text or "").encode()
    raw = np.frombuffer(whole, np.uint8).astype(np.int32)
    if len(raw) < 2:
        return np.zeros(TERMS, np.int64)
    out = np.bincount((raw[:-1] * 193 + raw[1:] * 7) & (PAIRS - 1), minlength=TERMS)
    words, lines = whole.split(), whole.split(b"\n")
    out[PAIRS:PAIRS + REPEATS] = 200 * sum(map(eq, words, words[1:])) // max(1, len(words))
    out[PAIRS + REPEATS:] = 200 * (len(lines) - len(set(lines))) // len(lines)
    return out


def _weighed(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts.astype(np.float32)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Latent space and vectors of a sample: counts (n, TERMS), labels 0 or 1."""
    base = float(labels.mean()) if len(labels) else 0.5
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    if not len(labels):
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, base)
    x = _weighed(counts, idf)
    values, left = np.linalg.eigh(x @ x.T)
    keep = [k for k in np.argsort(-values)[:DIMENSIONS] if values[k] > 1e-4]
    axes = (x.T @ left[:, keep] / np.sqrt(values[keep])).astype(np.float32)
    return Model(idf, axes, _unit(x @ axes), labels.astype(np.float32), base)


def scores(model: Model, counts: np.ndarray) -> np.ndarray:
    """Weighted votes of the nearest labelled vectors, one score a row."""
    if model.base in (0.0, 1.0) or not len(model.vectors):
        return np.where(counts.any(axis=1), model.base, 0.0)
    cosines = _unit(_weighed(counts, model.idf) @ model.axes) @ model.vectors.T
    k = min(NEIGHBOURS, len(model.vectors))
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosines, near, 1), 1e-6).astype(np.float64) ** SHARPNESS
    votes = (weight * model.labels[near]).sum(axis=1) / weight.sum(axis=1)
    return np.where(counts.any(axis=1), votes, 0.0)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for text, y in zip(*(c.to_pylist() for c in batch.columns)):
                yield term_counts(text).astype(np.uint32).tobytes(), y

    return emit({"terms": pa.binary(), "y": pa.int32()}, rows(), 256)


def fit_quality(docs: DataFrame, labels: DataFrame, allowed: Column, per_class: int = PER_CLASS) -> Model:
    """Fit on at most ``2 * per_class`` labelled documents of those ``allowed``."""
    sample = labelled_sample(docs, labels, "quality", allowed, per_class)
    rows = sample.select("doc_id", "text", "y").select("text", "y").mapInArrow(
        _count_rows, "terms binary, y int").collect()
    rows.sort(key=lambda r: (bytes(r["terms"]), r["y"]))
    counts = np.frombuffer(b"".join(r["terms"] for r in rows), np.uint32).reshape(len(rows), TERMS)
    labels = np.array([r["y"] for r in rows], float)
    del rows
    return fit(counts, labels)


def quality_score(model: Model, spark) -> object:
    """A column function of the text: score from 0 to 1."""
    shared = spark.sparkContext.broadcast(vars(model))  # plain values: a broadcast names its classes

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = Model(**shared.value)
        for texts in batches:
            out = [
                scores(held, np.array([term_counts(t) for t in texts.iloc[at:at + BLOCK]]))
                for at in range(0, len(texts), BLOCK)
            ]
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return score


def training_rows(folds: int, held: int) -> Column:
    return fold(F.col("doc_id"), folds) != held

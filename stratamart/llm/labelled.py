"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int) -> DataFrame:
    """(doc_id, text, y): at most ``per_class`` documents of either label.

    Ids are chosen by the smallest hash among the labels that ``allowed`` (over
    ``doc_id``) admits, so at most ``2 * per_class`` ids are broadcast. An id with
    several labels counts with its smallest, an id with several texts once.
    """
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
        .groupBy("doc_id").agg(F.min("y").alias("y"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = usable.where("y = 1").orderBy(*order).limit(per_class).unionByName(
        usable.where("y = 0").orderBy(*order).limit(per_class))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

"""From raw documents to packed sequences: the stages of a training corpus, in order.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but
the last return the columns of ``documents``; ``n_chars``, where there is one, follows a
changed text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm import line_dedup, minhash, mixing, packing, quality_knn
from stratamart.llm.common import stage, table
from stratamart.llm.labelled import fold
from stratamart.llm.queries import TOKENIZER

# Nearest neighbours vote, which SQL could say only by a cross join of all documents.
ORACLE_SQL = None


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Texts without terms are rejected."""
    labels = table(spark, sf_dir, "labels")
    model = quality_knn.fit_quality(docs, labels, fold(F.col("doc_id"), 3) != 1)
    score = quality_knn.quality_score(model, spark)
    return docs.where(score(F.col("text")) >= 0.5)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    return _with_length(line_dedup.drop_repeated_lines(docs).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates; rows without words all stay."""
    return minhash.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, each whole."""
    return mixing.mixture(docs)


def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packs", packs),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs

"""Registered queries of the subpackage: name -> function of (spark, folder of tables)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm import (
    config_packing, line_dedup, minhash, mixing, nearest, packing, quality_knn, quality_rules,
    substring_dedup, toxicity, turn_repair, url_filter, vector_codes,
)
from stratamart.llm.common import table
from stratamart.llm.labelled import fold

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)


def _classified(docs: DataFrame, score, folds: int, held: int) -> DataFrame:
    value = score(F.col("text"))
    scored = docs.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
        value.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return _classified(docs, toxicity.toxicity_score(model, spark), 5, 0)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    model = quality_knn.fit_quality(docs, labels, fold(F.col("doc_id"), 3) != 1)
    return _classified(docs, quality_knn.quality_score(model, spark), 3, 1)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")).select(
        "doc_id", "_judged.*")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_config_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config_packing.pack_few(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings")).drop("label")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_conversations(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_packing": op3_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_quality": op6_quality,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_nearest": op9_nearest,
    "op10_minhash": op10_minhash,
    "op11_config_packing": op11_config_packing,
    "op12_vector_codes": op12_vector_codes,
    "op13_turn_repair": op13_turn_repair,
}

"""Distinct keys over all loads without reading a load twice: a sketch per load, merged.

Each load leaves one row per table and key: its rows and a HyperLogLog sketch of its keys,
some 16 KB whatever the load's size. Sketches of loads are merged to count over any set of
them, so a load that is taken back or replaced is one row less or another one. Rows with a
NULL in the key are no keys, as for a distinct count. Empty loads count nothing. Where an
exact number is needed, ``checks.ingestion_check`` counts the rows themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.frames import stack_rows
from stratamart.operators.checks import ingestion_verdict

# Two to this power registers a sketch; the standard error of merged sketches follows from it.
PRECISION = 14
STANDARD_ERROR = 1.04 / 2 ** (PRECISION / 2)
# Standard errors within which an estimate is taken to lie.
ERRORS = 3


def _key(columns: Sequence[str]) -> Column:
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return F.when(whole, F.xxhash64(*columns))


def load_sketches(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[Sequence[str]]], load_id: int
) -> DataFrame:
    """One row per table and key of a load. A table is read once for all its keys."""
    found = []
    for name, df in tables.items():
        counted = df.agg(
            F.count("*").alias("row_count"),
            *[F.hll_sketch_agg(_key(key), F.lit(PRECISION)).alias(f"sketch_{i}")
              for i, key in enumerate(keys[name])],
        )
        each = F.array(*[
            F.struct(F.lit(",".join(key)).alias("key_columns"), F.col(f"sketch_{i}").alias("sketch"))
            for i, key in enumerate(keys[name])
        ])
        found.append(counted.select("row_count", F.explode(each).alias("k")).select(
            F.lit(name).alias("table_name"), "k.key_columns", "row_count", "k.sketch",
            F.lit(load_id).cast("long").alias("load_id")))
    return stack_rows(found)


def record_load(sketches: DataFrame, path: str) -> None:
    """Add a load to the folder of sketches; a load that comes again replaces itself."""
    (
        sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_id").parquet(path)
    )


def distinct_counts(loads: DataFrame) -> DataFrame:
    """Loads, rows and estimated distinct keys per table and key, with the bound of the error."""
    merged = loads.groupBy("table_name", "key_columns").agg(
        F.count_distinct("load_id").alias("loads"), F.sum("row_count").alias("row_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_keys"))
    bound = F.ceil(F.col("distinct_keys") * (ERRORS * STANDARD_ERROR)).cast("long")
    return merged.withColumn("error_bound", bound)


def ingestion_over_loads(loads: DataFrame, tables: Sequence[str]) -> DataFrame:
    """The ingestion check over all loads from their sketches: no table is read.

    The sketches must be of the check's own keys. A table without a load has no row.
    """
    counted = distinct_counts(loads)
    return stack_rows([
        ingestion_verdict(
            counted.where(F.col("table_name") == name).select(
                F.col("row_count").alias("record_count"), F.col("distinct_keys").alias("unique_keys")),
            name)
        for name in tables
    ])

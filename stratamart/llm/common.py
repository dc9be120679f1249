"""Helpers shared by the operators: staged tables, balanced joins, row batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.staging import stage

# A key is hot from this share of the rows on; there can be no more than 1 / share.
HOT_SHARE = 1 / 64
# Parts a hot key is dealt into.
SALTS = 64
WORD = r"[^\x20\x09-\x0D]+"

__all__ = [
    "HOT_SHARE", "SALTS", "WORD", "emit", "forget_worker_memory", "hot_keys", "partitions", "spread_join",
    "stage", "table", "worker_memory",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_memory(key: Hashable, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task under ``key``; made when it is not there.

    It keeps one key's memory at a time. Functions reach the workers by value, with globals
    of their own for every task, so it is held in a module of the worker. A new worker makes
    it again.
    """
    module = sys.modules.setdefault("_stratamart_memory", types.ModuleType("_stratamart_memory"))
    if getattr(module, "key", None) != key:
        forget_worker_memory()
        module.held, module.key = make(), key
    return module.held


def forget_worker_memory() -> None:
    """Drop what this Python worker keeps for an operator that ran before."""
    module = sys.modules.get("_stratamart_memory")
    if module is not None:
        module.held = module.key = None


def hot_keys(counts: DataFrame, key: str, n: str = "n", share: float = HOT_SHARE) -> list:
    """Keys with at least ``share`` of all rows, from one row per key and its count.

    At most ``1 / share`` values (64) come to the driver, whatever the size.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    return [r[0] for r in counts.where(F.col(n) >= max(2, total * share)).select(key).collect()]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot: list,
    by: Column,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join on ``key``; left rows of ``hot`` keys are dealt over salts by ``by``.

    Only the right rows of hot keys are repeated, once per salt. The result is that
    of the plain join, whatever ``hot`` holds.
    """
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    salted = left.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    )
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("_salt", F.explode(every))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def emit(columns: dict[str, pa.DataType], rows: Iterable[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of at most ``size`` rows."""
    schema = pa.schema(list(columns.items()))
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
    )

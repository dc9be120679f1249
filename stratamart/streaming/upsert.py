"""Incremental processing of a change feed: latest row per key, applied batch by batch.

A batch adds its own latest rows to a change table and touches nothing older, so
its cost follows the batch and not the table. The current rows are the latest per
key over the change table; ``compact`` writes them to a new table from time to time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratamart.operators.keys import latest_per_key

BATCH = "batch_id"


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    deleted: str | None = None,
) -> DataFrame:
    """``target`` after ``changes``: per key the row with the greatest ``sequence``.

    Where ``deleted`` (a boolean column) is set on that row, the key is gone.
    """
    both = target.unionByName(changes, allowMissingColumns=True)
    latest = latest_per_key(both, keys, sequence)
    return latest if deleted is None else latest.where(~F.coalesce(F.col(deleted), F.lit(False)))


def start_upsert(
    changes: DataFrame, path: str, checkpoint: str, keys: Sequence[str], sequence: Sequence[str]
) -> StreamingQuery:
    """Write each batch's latest rows under its own batch number.

    A batch that runs again after a failure overwrites its own folder only.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        latest_per_key(batch, keys, sequence).write.mode("overwrite").parquet(
            f"{path}/{BATCH}={number}"
        )

    return (
        changes.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_rows(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    sequence: Sequence[str],
    deleted: str | None = None,
) -> DataFrame:
    """Latest row per key over all batches; between equal sequences the later batch wins."""
    log = spark.read.parquet(path)
    latest = latest_per_key(log, keys, [*sequence, BATCH])
    if deleted is not None:
        latest = latest.where(~F.coalesce(F.col(deleted), F.lit(False)))
    return latest.drop(BATCH)


def compact(
    spark: SparkSession,
    path: str,
    new_path: str,
    keys: Sequence[str],
    sequence: Sequence[str],
    deleted: str | None = None,
) -> DataFrame:
    """Write the latest rows as the first batch of a new change table; its current rows.

    The new table keeps the rows that mark a deletion: without them a change that is
    older than the deletion, but arrives later, would bring the key back.
    """
    current_rows(spark, path, keys, sequence).write.mode("errorifexists").parquet(
        f"{new_path}/{BATCH}=-1"
    )
    return current_rows(spark, new_path, keys, sequence, deleted)

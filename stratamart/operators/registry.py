"""Surrogate keys that stay: a registry of natural keys and the numbers they were given.

Numbering a dimension anew at every refresh changes the keys of old rows as soon as a row is
added in between. A registry keeps what was given: one batch of new natural keys at a time,
numbered from the highest number before on. Batches are folders; a batch that runs again
replaces itself, and sees only the batches before it, so it gives the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.operators.keys import number_rows
from stratamart.operators.partitions import same_keys
from stratamart.sources import folders
from stratamart.staging import stage

BATCH = "batch_id"


class KeyRegistry:
    """Natural keys (one or more columns, null equal to null) and their numbers, from 1 on."""

    def __init__(self, spark: SparkSession, path: str, natural: Sequence[str], key: str) -> None:
        self.spark, self.path, self.natural, self.key = spark, path, list(natural), key

    def _batches(self, before: int | None) -> list[int]:
        found = [int(n.partition("=")[2]) for n in folders.children(self.spark, f"{self.path}/marks")]
        return [b for b in found if before is None or b < before]

    def high_water(self, before: int | None = None) -> int:
        """The greatest number given, by the batches before one."""
        batches = self._batches(before)
        if not batches:
            return 0
        return self.spark.read.parquet(f"{self.path}/marks/{BATCH}={max(batches)}").first()["high"]

    def keys(self, like: DataFrame, before: int | None = None) -> DataFrame:
        """Natural keys and their numbers; ``like`` gives the types of the natural keys."""
        paths = [f"{self.path}/keys/{BATCH}={b}" for b in self._batches(before)]
        wanted = like.select(*self.natural).withColumn(self.key, F.lit(0).cast("long"))
        if not paths:
            return self.spark.createDataFrame([], wanted.schema)
        return self.spark.read.schema(wanted.schema).parquet(*paths)

    def assign(self, rows: DataFrame, batch: int) -> DataFrame:
        """Numbers of the natural keys of ``rows``; keys not seen before ``batch`` get new ones.

        The registry is only scanned for the keys asked about; just those and the new ones are
        shuffled, as long as Spark can broadcast the keys asked about.
        """
        asked = stage(rows.select(*self.natural).distinct(), "asked")
        known = stage(same_keys(self.keys(asked, batch), asked, self.natural, "left_semi"), "known")
        fresh = same_keys(asked, known, self.natural, "left_anti")
        high = self.high_water(batch)
        numbered = number_rows(fresh, self.natural, self.key).withColumn(self.key, F.col(self.key) + high)
        target = f"{self.path}/keys/{BATCH}={batch}"
        numbered.select(*self.natural, self.key).write.mode("overwrite").parquet(target)
        given = self.spark.read.schema(known.schema).parquet(target)
        # The mark is written last: a batch without one was not finished and does not count.
        mark = given.agg((F.lit(high) + F.count("*")).alias("high"))
        mark.write.mode("overwrite").parquet(f"{self.path}/marks/{BATCH}={batch}")
        return known.unionByName(given)

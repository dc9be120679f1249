"""Reliable intermediate tables.

Some operators have to read the same rows twice and need both reads to agree
(row positions, for instance). They write the rows once, as Parquet, to the
shared folder the session names in ``spark.checkpoint.dir``. Executors may be
lost at any time after that: the rows are in the shared folder, not on them.

Written rows and shuffle files take disk until the application ends. A long run does its
steps inside ``scratch``, which gives both back as soon as they are read for the last time.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from stratamart.sources import folders

# Spark then deletes the shuffle files of an execution at its end, not once the driver's
# garbage happens to be collected.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: list[tempfile.TemporaryDirectory] = []
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError(
            "spark.checkpoint.dir is not set: on a cluster the staged tables need a shared folder"
        )
    if not _local_folders:
        _local_folders.append(tempfile.TemporaryDirectory(prefix="stratamart-"))
    return _local_folders[0].name


def staged_root(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_folder(spark)}/stratamart/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{staged_root(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete what this application has staged, once its results are saved elsewhere."""
    folders.delete(spark, staged_root(spark))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is staged inside; shuffle files go with each execution.

    Nothing that reads the staged rows may leave the block, so results are saved inside it.
    """
    before, paths = spark.conf.get(DROP_SHUFFLES, None), []
    outer = _scratch.set(paths)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        _scratch.reset(outer)
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
        for path in paths:
            folders.delete(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written rows."""
    spark = df.sparkSession
    path = new_path(spark, label)
    if (paths := _scratch.get()) is not None:
        paths.append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

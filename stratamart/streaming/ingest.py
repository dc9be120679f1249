"""File-stream ingestion: new files become bronze rows, cleaned by the batch functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratamart.sources.csv_files import with_lineage


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "csv",
    source: str | None = None,
    **options: str,
) -> DataFrame:
    """A stream of the files under ``path``. Streams need a schema; none is inferred."""
    if fmt == "csv":
        options = {"header": "true", **options}
    df = spark.readStream.format(fmt).schema(schema).options(**options).load(path)
    return with_lineage(df, source) if source else df


def write_available(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Take in what has arrived since the last run, then stop. The file sink commits each
    batch once, so a run that fails and starts again neither loses nor repeats rows."""
    return (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def ingest_stream(
    bronze: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Clean a bronze stream with a silver function (narrow, so it streams as is)."""
    return write_available(clean(bronze), path, checkpoint)

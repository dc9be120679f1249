"""Catalog: schemas and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratamart import fixed_values as V


def use_catalog(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentCatalog(name)


def create_schemas(
    spark: SparkSession,
    names: Mapping[str, str] = V.LAYER_SCHEMAS,
    *,
    prefix: str = "",
    location: str | None = None,
) -> list[str]:
    """Create the schemas that are absent, with comments; returns their names."""
    created = []
    for name, comment in names.items():
        schema = f"{prefix}{name}"
        where = f" LOCATION '{location}/{schema}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` COMMENT '{comment}'{where}")
        created.append(schema)
    return created


def schema_status(spark: SparkSession, required: Sequence[str]) -> DataFrame:
    """One row per required schema: is it there?"""
    present = spark.sql("SHOW DATABASES").select(F.col("namespace").alias("_found"))
    wanted = spark.range(1).select(
        F.explode(F.array(*[F.lit(r) for r in required])).alias("schema_name")
    )
    return wanted.join(present, wanted["schema_name"] == present["_found"], "left").select(
        "schema_name", F.col("_found").isNotNull().alias("found")
    )


def save_table(
    df: DataFrame,
    name: str,
    *,
    mode: str = "overwrite",
    fmt: str = "parquet",
    overwrite_schema: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Write a table. Full refresh unless ``mode`` says otherwise.

    ``df`` must not read the table it replaces. ``overwrite_schema`` is for Delta;
    a Parquet refresh replaces the schema anyway.
    """
    writer = df.write.mode(mode).format(fmt)
    if overwrite_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def save_counted(df: DataFrame, name: str, **options) -> int:
    """``save_table``, and the number of rows written, counted in the same job.

    The count is observed on the rows as they are written, in the write's own tasks. Spark
    takes the count of each of these once: what a repeated task counted again is left out.
    """
    seen = Observation()
    save_table(df.observe(seen, F.count(F.lit(1)).alias("row_count")), name, **options)
    return seen.get["row_count"]


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def query(
    spark: SparkSession, sql: str, args: Mapping[str, object] | None = None, **tables: DataFrame
) -> DataFrame:
    """Run a SQL statement. ``:name`` stands for a value of ``args``, ``{name}`` for a
    DataFrame given by that name."""
    return spark.sql(sql, dict(args) if args else None, **tables)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 10) -> DataFrame:
    """First rows in a stated order: a top-k, not a sort of the whole table."""
    return df.orderBy(*order_by).limit(rows)

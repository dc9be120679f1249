"""CSV extracts → bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart import fixed_values as V
from stratamart.schemas import BRONZE_SCHEMAS, EXTRACT_SCHEMAS


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """CSV with a header line. Without a schema Spark infers one, at the price of a pass."""
    reader = spark.read.option("header", "true").options(**options)
    reader = reader.option("inferSchema", "true") if schema is None else reader.schema(schema)
    return reader.csv(path)


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all read as text, so that type checks can see bad values."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def _exact(text: Column, kind: T.DataType) -> Column:
    """The value of a text, NULL where it has none or the type would cut its fraction."""
    if isinstance(kind, T.IntegralType):
        number = text.try_cast(T.DecimalType(38, 10))
        return F.when(number == F.floor(number), number.try_cast(kind))
    if isinstance(kind, T.DecimalType):
        number = text.try_cast(T.DecimalType(38, 18))
        return F.when(number == number.try_cast(kind), number.try_cast(kind))
    return text.try_cast(kind)


def read_checked(
    spark: SparkSession, path: str | list[str], schema: T.StructType, *, files: bool = False
) -> DataFrame:
    """CSV columns found by their header names, cast to ``schema``, with what does not fit kept.

    ``_rejected`` maps a column to its text where that is no value of the column's type, or
    has a fraction that the type would cut; it is NULL for a clean row. A column that the
    header lacks is an error, and so is a file whose header differs from the other files'.
    Columns beyond the schema are left out. Rows of NULL have no rejects. ``files`` adds where
    a row was read: ``_source_file``, ``_source_modified`` and ``_source_block``, the place in
    the file where the part that held the row begins.
    """
    text = spark.read.option("header", "true").option("enforceSchema", "false").csv(path)
    missing = [f.name for f in schema.fields if f.name not in text.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
    cells, bad = [], []
    for field in schema.fields:
        raw = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            cells.append(raw)
            continue
        trimmed = F.trim(raw)
        value = _exact(trimmed, field.dataType)
        cells.append(value.alias(field.name))
        cell = F.struct(F.lit(field.name).alias("column"), raw.alias("value"))
        bad.append(F.when((trimmed != "") & value.isNull(), cell))
    found = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array()
    rejected = F.when(F.size(found) > 0, F.map_from_entries(found)) if bad else F.lit(None)
    place = [
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_modified"),
        F.col("_metadata.file_block_start").alias("_source_block"),
    ] if files else []
    return text.select(*cells, rejected.cast("map<string,string>").alias("_rejected"), *place)


def rejects(bronze: DataFrame, source: str) -> DataFrame:
    """Rejected values per column: table_name, column_name, rejected."""
    return (
        bronze.select(F.explode("_rejected").alias("column_name", "value"))
        .groupBy("column_name").agg(F.count("*").alias("rejected"))
        .select(F.lit(source).alias("table_name"), "column_name", "rejected")
    )


def rejects_by_file(bronze: DataFrame, source: str) -> DataFrame:
    """Rejected values per file and column: table_name, source_file, column_name, rejected.

    Values are counted per task before they are shuffled.
    """
    return (
        bronze.select(F.col("_source_file").alias("source_file"), F.explode("_rejected").alias("column_name", "value"))
        .groupBy("source_file", "column_name").agg(F.count("*").alias("rejected"))
        .select(F.lit(source).alias("table_name"), "source_file", "column_name", "rejected")
    )


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    """Add when and from where a row came."""
    return df.withColumns({"_ingest_ts": F.current_timestamp(), "_source_table": F.lit(source)})


def read_source(
    spark: SparkSession, root: str, table: str, *, infer: bool = False, lineage: bool = True,
    text: bool = False, checked: bool = False, schema: T.StructType | None = None,
) -> DataFrame:
    """One source table from its file (or folder of files) under ``root``.

    ``checked`` matches columns by header, adds ``_rejected`` and, with ``lineage``, the file of
    each row (see ``read_checked``). ``schema`` replaces the table's own: the wide one where
    checked, else that of bronze.
    """
    path = f"{root}/{V.SOURCE_FILES[table]}"
    if checked:
        df = read_checked(spark, path, schema or EXTRACT_SCHEMAS[table], files=lineage)
        return with_lineage(df, table) if lineage else df
    schema = None if infer else schema or BRONZE_SCHEMAS[table]
    if text and schema is not None:
        schema = as_text(schema)
    df = read_csv(spark, path, schema)
    return with_lineage(df, table) if lineage else df

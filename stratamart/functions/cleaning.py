"""Cleaning steps on columns, built from Spark's own expressions only.

A step takes the name of a column, or any SQL expression, and gives a Column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart import fixed_values as V


def literal(value: object) -> str:
    """A Python value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim spaces from every string column, in one projection."""
    return df.selectExpr(*[
        f"trim(`{f.name}`) AS `{f.name}`" if isinstance(f.dataType, T.StringType)
        else f"`{f.name}`"
        for f in df.schema.fields
    ])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename from a map; names match regardless of case, absent ones are skipped."""
    by_lower = {old.lower(): new for old, new in names.items()}
    return df.withColumnsRenamed({
        c: by_lower[c.lower()] for c in df.columns if c.lower() in by_lower
    })


def map_codes(
    col: str,
    codes: Mapping[str, object],
    default: object = V.UNKNOWN,
    *,
    ignore_case: bool = True,
    passthrough: bool = False,
) -> Column:
    """Replace codes by labels.

    Unknown codes and NULL give ``default``. With ``passthrough`` only NULL and
    the empty string give ``default``; any other value stays as it is.
    """
    key = f"upper({col})" if ignore_case else col
    by_label: dict[object, list[str]] = {}
    for code, label in codes.items():
        by_label.setdefault(label, []).append(literal(code))
    whens = [f"WHEN {key} IN ({', '.join(c)}) THEN {literal(la)}" for la, c in by_label.items()]
    if passthrough:
        whens.append(f"WHEN {col} IS NULL OR {col} = '' THEN {literal(default)}")
    other = col if passthrough else literal(default)
    return F.expr(f"CASE {' '.join(whens)} ELSE {other} END")


def yes_no(col: str) -> Column:
    """YES → true, NO → false, anything else NULL."""
    return map_codes(col, V.YES_NO, None)


def category_of(product_key: str) -> Column:
    """Category id held in the leading characters of a source product key."""
    return F.expr(f"translate(substring({product_key}, 1, {V.CATEGORY_ID_LENGTH}), '-', '_')")


def number_of(product_key: str) -> Column:
    """Product number: what follows the category id and its separator."""
    return F.expr(f"substring({product_key}, {V.PRODUCT_NUMBER_START})")


def strip_prefix(col: str, prefix: str) -> Column:
    """Drop a leading ``prefix`` where present."""
    return F.expr(
        f"CASE WHEN startswith({col}, {literal(prefix)}) "
        f"THEN substring({col}, {len(prefix) + 1}) ELSE {col} END"
    )


def remove_chars(col: str, chars: str) -> Column:
    """Delete every occurrence of the given characters."""
    return F.expr(f"translate({col}, {literal(chars)}, '')")


def default_zero(col: str) -> Column:
    return F.expr(f"coalesce({col}, 0)")


def date_code(col: str) -> Column:
    """Integer ``yyyyMMdd`` → date; 0, other than 8 digits and impossible dates → NULL.

    Splits the number instead of parsing text: several times faster per row. Text
    columns are read as numbers first.
    """
    low, high = V.DATE_CODE_RANGE
    code = f"try_cast({col} AS int)"
    return F.expr(
        f"CASE WHEN {code} BETWEEN {low} AND {high} THEN CAST(try_make_timestamp_ntz("
        f"int({code} div 10000), int({code} div 100) % 100, {code} % 100, 0, 0, 0) AS date) END"
    )


def as_date(col: str) -> Column:
    """Date value of a date, timestamp or text column; NULL where there is none."""
    return F.expr(f"try_cast({col} AS date)")


def ordered_range(start: str, end: str) -> tuple[Column, Column]:
    """Start and end with inverted pairs swapped; an open end stays open."""
    return (
        F.expr(f"CASE WHEN {end} < {start} THEN {end} ELSE {start} END"),
        F.expr(f"CASE WHEN {end} < {start} THEN {start} ELSE {end} END"),
    )


def null_future(col: str, as_of: dt.date | None = None) -> Column:
    """Dates after ``as_of`` (today unless given) → NULL."""
    limit = "current_date()" if as_of is None else literal(as_of)
    return F.expr(f"CASE WHEN {col} > {limit} THEN NULL ELSE {col} END")


def repaired_price(price: str, sales: str, quantity: str) -> Column:
    """Missing or non-positive price → sales / quantity, NULL when quantity is 0."""
    return F.expr(
        f"CASE WHEN {price} IS NULL OR {price} <= 0 THEN try_divide({sales}, {quantity}) "
        f"ELSE double({price}) END"
    )


def prefer(primary: str, fallback: str, unknown: str = V.UNKNOWN) -> Column:
    """The primary source's value unless unknown, else the fallback's, else unknown."""
    text = literal(unknown)
    return F.expr(
        f"CASE WHEN {primary} <> {text} THEN {primary} ELSE coalesce({fallback}, {text}) END"
    )

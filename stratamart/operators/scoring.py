"""Scores 0–100, their status and issue texts, computed as columns on one-row frames.

The driver reads nothing but the finished row, and that only for the gate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart import fixed_values as V
from stratamart.functions.frames import fill, listed, one_row, tiers
from stratamart.operators.checks import (
    fact_measures,
    key_measures,
    sales_measures,
    table_counts,
)


def status_of(score: Column) -> Column:
    return tiers(
        (score < V.CRITICAL_BELOW_SCORE, V.CRITICAL),
        (score < V.PASS_SCORE, V.WARNING),
        otherwise=V.PASS,
    )


def _counted(**tables: DataFrame) -> DataFrame:
    return one_row(*[df.agg(F.count("*").alias(name)) for name, df in tables.items()])


def _bounded(score: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("int")


def _points(conditions: list[tuple[Column, int]]) -> Column:
    """Points lost, where a condition is NULL nothing is lost."""
    return reduce(
        lambda total, c: total + F.when(c[0], c[1]).otherwise(0), conditions, F.lit(0)
    )


def _finish(df: DataFrame, score: Column) -> DataFrame:
    return df.withColumn("quality_score", _bounded(score)).withColumn(
        "status", status_of(F.col("quality_score"))
    )


def _bronze_score(counts: DataFrame, empty, low, all_empty: str, summary: str) -> DataFrame:
    names = counts.columns
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    some = reduce(lambda a, b: a & b, [F.col(n) > 0 for n in names])
    lost = [(F.col(n) < floor, points) for n, floor, points, _ in low]
    score = tiers(
        (total == 0, F.lit(0)),
        *[(F.col(n) == 0, F.lit(s)) for n, s, _ in empty],
        otherwise=F.lit(100) - _points(lost),
    )
    issue = tiers(
        (total == 0, F.lit(all_empty)),
        *[(F.col(n) == 0, F.lit(text)) for n, _, text in empty],
        otherwise=F.lit(None).cast("string"),
    )
    warned = [
        F.when(some & (F.col(n) < floor), fill(text, n=F.col(n))) for n, floor, _, text in low
    ]
    scored = counts.withColumns({
        "total_records": total,
        "record_count_pass": total > 0,
        "completeness_pct": F.when(total > 0, 100.0).otherwise(0.0),
        "critical_issues": listed(issue),
        "warnings": listed(*warned),
        "full_metrics": fill(summary, total=total, **{n: F.col(n) for n in names}),
    })
    return _finish(scored, score)


def bronze_crm_score(customers: DataFrame, products: DataFrame, sales: DataFrame) -> DataFrame:
    scored = _bronze_score(
        _counted(customers=customers, products=products, sales=sales),
        V.BRONZE_CRM_EMPTY, V.BRONZE_CRM_LOW, V.BRONZE_CRM_ALL_EMPTY, V.BRONZE_CRM_SUMMARY,
    )
    return scored.withColumnsRenamed({
        "customers": "unique_customers", "products": "unique_products", "sales": "unique_orders",
    })


def bronze_erp_score(cust_ids: DataFrame, locations: DataFrame, categories: DataFrame) -> DataFrame:
    scored = _bronze_score(
        _counted(cust_ids=cust_ids, locations=locations, categories=categories),
        V.BRONZE_ERP_EMPTY, V.BRONZE_ERP_LOW, V.BRONZE_ERP_ALL_EMPTY, V.BRONZE_ERP_SUMMARY,
    )
    return scored.withColumnsRenamed({
        "cust_ids": "unique_customers", "categories": "unique_products",
    }).drop("locations")


def silver_score(bronze: DataFrame, silver: DataFrame, table: str) -> DataFrame:
    """100 when every bronze row is in silver, else 85."""
    return silver_score_of(table_counts(bronze, silver), table)


def silver_score_of(counts: DataFrame, table: str) -> DataFrame:
    """The same from one row of ``bronze_count`` and ``silver_count``."""
    b, s = F.col("bronze_count"), F.col("silver_count")
    _, summary = V.SILVER_TASKS[table]
    scored = counts.select(
        s.alias("total_records"),
        (b == s).alias("record_count_pass"),
        F.coalesce(F.try_divide(s * 100.0, b), F.lit(0.0)).alias("completeness_pct"),
        fill(summary, silver=s, bronze=b).alias("full_metrics"),
    )
    return _finish(
        scored, F.when(F.col("record_count_pass"), 100).otherwise(V.SILVER_MISMATCH_SCORE)
    )


def dimension_score(customers: DataFrame, products: DataFrame) -> DataFrame:
    """Empty dimension → 0; small ones lose points. Never below 0."""
    counts = _counted(customers=customers, products=products)
    empty = reduce(lambda a, b: a | b, [F.col(n) == 0 for n in V.DIM_EMPTY])
    lost = [(F.col(n) < floor, points) for n, floor, points, _ in V.DIM_LOW]
    scored = counts.withColumns({
        "total_records": F.col("customers") + F.col("products"),
        "record_count_pass": ~empty,
        "completeness_pct": F.lit(100.0),
        "critical_issues": listed(
            *[F.when(F.col(n) == 0, text) for n, text in V.DIM_EMPTY.items()]
        ),
        "warnings": listed(
            *[F.when(F.col(n) < floor, fill(text, n=F.col(n))) for n, floor, _, text in V.DIM_LOW]
        ),
        "full_metrics": fill(
            V.DIM_SUMMARY, customers=F.col("customers"), products=F.col("products")
        ),
    })
    scored = _finish(scored, F.when(empty, 0).otherwise(100) - _points(lost))
    return scored.withColumnsRenamed({
        "customers": "unique_customers", "products": "unique_products",
    })


def fact_score_columns(measured: DataFrame) -> DataFrame:
    """Score each row of fact measures; used for the whole table and per period."""
    gold, silver = F.col("gold_revenue"), F.col("silver_revenue")
    pct = F.when(
        gold.isNotNull() & silver.isNotNull(),
        F.coalesce(F.abs(F.try_divide(gold - silver, silver)) * 100, F.lit(0.0)),
    )
    lost = [
        (F.col("gold_count") != F.col("silver_count"), V.FACT_COUNT_POINTS,
         fill(V.FACT_COUNT_ISSUE, gold=F.col("gold_count"), silver=F.col("silver_count"))),
        (pct > V.REVENUE_TOLERANCE_PCT, V.FACT_REVENUE_POINTS,
         fill(V.FACT_REVENUE_ISSUE, pct=F.format_string("%.4f", pct))),
    ] + [
        (F.col(c) > 0, V.FACT_ROW_POINTS, fill(text, n=F.col(c)))
        for c, text in [
            ("null_product_keys", V.FACT_NULL_PRODUCT_ISSUE),
            ("null_customer_keys", V.FACT_NULL_CUSTOMER_ISSUE),
            ("negative_sales", V.FACT_NEGATIVE_ISSUE),
        ]
    ]
    # A zero revenue counts as not comparable, like a missing one.
    comparable = (gold != 0) & (silver != 0)
    scored = measured.withColumns({
        "total_records": F.col("gold_count"),
        "record_count_pass": F.col("gold_count") == F.col("silver_count"),
        "revenue_reconciliation_pass": F.when(comparable, pct < V.REVENUE_TOLERANCE_PCT),
        "revenue_diff_pct": F.when(comparable, pct),
        "completeness_pct": F.lit(100.0),
        "critical_issues": listed(*[F.when(c, text) for c, _, text in lost]),
        "full_metrics": fill(
            V.FACT_SUMMARY, n=F.col("gold_count"),
            revenue=F.coalesce(F.format_number(gold, 2), F.lit("0.00")),
        ),
    })
    scored = _finish(scored, F.lit(100) - _points([(c, p) for c, p, _ in lost]))
    return scored.withColumnsRenamed({
        "gold_revenue": "revenue_gold", "silver_revenue": "revenue_silver",
        "price_calc_errors": "price_calculation_errors",
    })


def fact_score(
    sales: DataFrame, fact: DataFrame,
    products: DataFrame | None = None, customers: DataFrame | None = None,
) -> DataFrame:
    """Score of the fact; with both dimensions given, orphans are measured as well.

    Keys and other columns are then measured apart, so that a fact that is only planned is
    never looked up with all its columns.
    """
    measured = fact_measures(fact)
    if products is None or customers is None:
        return fact_score_columns(one_row(sales_measures(sales), measured))
    keyed = key_measures(fact, products, customers)
    parts = [
        measured.drop("null_product_keys", "null_customer_keys", "null_keys"), keyed,
        measured.select("null_keys"),
    ]
    names = [*measured.columns, "orphaned_products", "orphaned_customers"]
    together = one_row(sales_measures(sales), *parts)
    return fact_score_columns(together.select("silver_count", "silver_revenue", *names))


def fact_score_by_month(sales: DataFrame, fact: DataFrame) -> DataFrame:
    """The fact score of every order month, as ``month`` and scored columns.

    Sales without an order date are a row of their own, with a NULL month.
    """
    month = F.trunc("order_date", "month").alias("month")
    measured = one_row(sales_measures(sales, month), fact_measures(fact, month), by=("month",))
    counts = [c for c in measured.columns if c != "month" and not c.endswith("_revenue")]
    return fact_score_columns(measured.fillna(0, subset=counts))

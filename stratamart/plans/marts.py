"""Reporting marts on the star schema.

Every mart sums the fact per dimension key before it joins the dimension: a hot
customer or product reaches the join as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart import fixed_values as V
from stratamart.operators.keys import equal_parts

ALL = "(all)"


def _per_key(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(
        F.sum("sales_amount").alias("revenue"), F.count("*").alias("lines")
    )


def revenue_by_country(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales lines and revenue per customer country; sales without a customer are n/a."""
    places = customers.select(F.col("customer_key").alias("_key"), "country")
    per_customer = _per_key(fact, "customer_key")
    return (
        per_customer.join(places, F.col("customer_key") == F.col("_key"), "left")
        .groupBy(F.coalesce("country", F.lit(V.UNKNOWN)).alias("country"))
        .agg(F.sum("lines").alias("lines"), F.sum("revenue").alias("revenue"))
    )


def revenue_by_region(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue by country and gender with totals per country and over all."""
    who = customers.select(F.col("customer_key").alias("_key"), "country", "gender")
    detail = (
        _per_key(fact, "customer_key")
        .join(who, F.col("customer_key") == F.col("_key"), "left")
        .select(
            F.coalesce("country", F.lit(V.UNKNOWN)).alias("country"),
            F.coalesce("gender", F.lit(V.UNKNOWN)).alias("gender"),
            "lines", "revenue",
        )
    )
    return (
        detail.rollup("country", "gender")
        .agg(F.sum("lines").alias("lines"), F.sum("revenue").alias("revenue"))
        .select(
            F.coalesce("country", F.lit(ALL)).alias("country"),
            F.coalesce("gender", F.lit(ALL)).alias("gender"),
            "lines", "revenue",
        )
    )


def customer_totals(fact: DataFrame) -> DataFrame:
    """Revenue, orders, lines and order dates per known customer."""
    return (
        fact.where(F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(
            F.coalesce(F.sum("sales_amount"), F.lit(0)).alias("revenue"),
            F.count_distinct("order_number").alias("orders"),
            F.count("*").alias("lines"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
    )


def customer_lifetime_value(fact: DataFrame, customers: DataFrame) -> DataFrame:
    who = customers.select(F.col("customer_key").alias("_key"), "customer_id", "country")
    return (
        customer_totals(fact)
        .join(who, F.col("customer_key") == F.col("_key"), "left")
        .select(
            "customer_key", "customer_id", "country", "revenue", "orders", "lines",
            "first_order", "last_order",
            F.try_divide("revenue", "orders").alias("average_order"),
        )
    )


def _product_revenue(fact: DataFrame, products: DataFrame) -> DataFrame:
    names = products.select(
        F.col("product_key").alias("_key"), "product_number", "product_name",
        F.coalesce("category", F.lit(V.UNKNOWN)).alias("category"),
    )
    sold = _per_key(fact.where(F.col("product_key").isNotNull()), "product_key")
    return sold.join(names, F.col("product_key") == F.col("_key"), "left").select(
        "category", "product_key", "product_number", "product_name",
        F.coalesce("revenue", F.lit(0)).alias("revenue"), "lines",
    )


def top_products(fact: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The n products with the most revenue."""
    return _product_revenue(fact, products).orderBy(F.desc("revenue"), "product_key").limit(n)


def top_products_by_category(fact: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    order = Window.partitionBy("category").orderBy(F.desc("revenue"), "product_key")
    ranked = _product_revenue(fact, products).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= n)


def customer_segments(fact: DataFrame, customers: DataFrame, **part_options: int) -> DataFrame:
    """Recency, frequency and value fifths (5 is best), a tier and a segment per customer."""
    who = customers.select(F.col("customer_key").alias("_key"), "country")
    totals = customer_totals(fact).join(
        who, F.col("customer_key") == F.col("_key"), "left"
    ).select("customer_key", "country", "last_order", "orders", "revenue")
    scored = equal_parts(
        totals, 5,
        {
            "recency": ["last_order", "customer_key"],
            "frequency": ["orders", "customer_key"],
            "value": ["revenue", "customer_key"],
        },
        **part_options,
    )
    r, f, m = F.col("recency"), F.col("frequency"), F.col("value")
    return scored.withColumns({
        "tier": F.when(m == 5, "High").when(m >= 3, "Medium").otherwise("Low"),
        "segment": F.when((r >= 4) & (f >= 4), "Champions")
        .when(f >= 4, "Loyal")
        .when(r >= 4, "Recent")
        .when((r <= 2) & (f <= 2), "At risk")
        .otherwise("Regular"),
    })


def kpi_trend(fact: DataFrame) -> DataFrame:
    """Monthly revenue, orders, customers and average order, with growth on the month before.

    Sales without a date are in a row without a month, so the rows sum to the fact; they
    take no part in growth. Lines are summed per order before distinct orders and customers
    are counted. The window runs over one row per month, whatever the size of the fact.
    """
    per_order = (
        fact.groupBy(
            F.trunc("order_date", "month").alias("month"), "order_number", "customer_key"
        )
        .agg(F.sum("sales_amount").alias("revenue"))
    )
    monthly = (
        per_order.groupBy("month")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.count_distinct("order_number").alias("orders"),
            F.count_distinct("customer_key").alias("customers"),
        )
    )
    before = F.lag("revenue").over(Window.partitionBy(F.col("month").isNull()).orderBy("month"))
    return monthly.select(
        "month", "revenue", "orders", "customers",
        F.try_divide("revenue", "orders").alias("average_order"),
        (F.try_divide(F.col("revenue") - before, before) * 100).alias("growth_pct"),
    )

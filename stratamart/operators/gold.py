"""Silver → gold: two dimensions with surrogate keys and the sales fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stratamart.functions.cleaning import prefer
from stratamart.operators.joins import hot_keys_for, hot_right_keys, left_lookup
from stratamart.operators.keys import newest_key, number_rows

CUSTOMER_COLUMNS = [
    "customer_id", "firstname", "lastname", "country", "marital_status", "gender",
    "birthdate", "create_date",
]
PRODUCT_COLUMNS = [
    "product_id", "product_number", "product_name", "category_id", "category",
    "subcategory", "maintenance_flag", "product_line", "start_date",
]


def customer_rows(
    crm: DataFrame, demographics: DataFrame, location: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """Customers with what the second system knows about them, before numbering.

    ``customer_key`` is the business key here, the surrogate key in gold. ``keep`` names
    further columns of ``crm`` to carry along.
    """
    demo = demographics.selectExpr(
        "customer_number", "gender AS _erp_gender", "birth_date AS birthdate"
    )
    place = location.select("customer_number", "country")
    base = crm.selectExpr(
        "customer_key", "customer_id", "firstname", "lastname", "marital_status", "gender",
        "created_date AS create_date", *keep,
    )
    found = hot_keys_for(base, ("customer_key", demo), ("customer_key", place))
    hot = found.get("customer_key")
    joined = left_lookup(
        left_lookup(
            base, demo, "customer_key", "customer_number",
            hot=hot, hot_right=hot_right_keys(demo, "customer_number"),
        ),
        place, "customer_key", "customer_number",
        hot=hot, hot_right=hot_right_keys(place, "customer_number"),
    )
    return joined.withColumn(
        "gender", prefer("gender", "_erp_gender")
    ).select(*CUSTOMER_COLUMNS, *keep)


def dim_customers(
    crm: DataFrame, demographics: DataFrame, location: DataFrame, **key_options: int
) -> DataFrame:
    rows = customer_rows(crm, demographics, location)
    return number_rows(rows, ["customer_id"], "customer_key", **key_options)


def product_rows(
    products: DataFrame, categories: DataFrame, current_only: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Products, every version unless ``current_only``, with their category."""
    if current_only:
        products = products.where("end_date IS NULL")
    base = products.select(
        "product_id", "product_number", "product_name", "category_id", "product_line", "start_date",
        *keep,
    )
    cats = categories.selectExpr(
        "category_id AS _cat", "category", "subcategory", "maintenance_flag"
    )
    hot = hot_keys_for(base, ("category_id", cats)).get("category_id")
    return left_lookup(
        base, cats, "category_id", "_cat", hot=hot, hot_right=hot_right_keys(cats, "_cat")
    ).select(*PRODUCT_COLUMNS, *keep)


def dim_products(
    products: DataFrame, categories: DataFrame, current_only: bool = False, **key_options: int
) -> DataFrame:
    rows = product_rows(products, categories, current_only)
    return number_rows(rows, ["start_date", "product_number"], "product_key", **key_options)


def fact_sales(
    sales: DataFrame, products: DataFrame, customers: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """Sales with the newest surrogate key per natural key; negative amounts dropped.

    Keys without a dimension row stay NULL. Rows are filtered before the lookups,
    and each lookup side is one row per key, so no sale is multiplied. ``keep`` names
    further columns of ``sales`` to carry along.
    """
    base = [
        "order_number", "product_number", "customer_id", "order_date", "ship_date",
        "due_date", "sales_amount", "quantity", "price",
    ]
    extra = [c for c in keep if c not in base]
    kept = sales.where("sales_amount IS NULL OR sales_amount >= 0").select(*base, *extra)
    product_keys = newest_key(products, "product_number", "product_key")
    customer_keys = newest_key(customers, "customer_id", "customer_key")
    hot = hot_keys_for(
        kept, ("product_number", product_keys), ("customer_id", customer_keys)
    )
    with_product = left_lookup(
        kept, product_keys.withColumnRenamed("product_number", "_number"),
        "product_number", "_number", hot=hot.get("product_number"),
    )
    with_customer = left_lookup(
        with_product, customer_keys.withColumnRenamed("customer_id", "_id"),
        "customer_id", "_id", hot=hot.get("customer_id"),
    )
    return with_customer.select(
        "order_number", "product_key", "customer_key", "order_date", "ship_date", "due_date",
        "sales_amount", "quantity", "price", *[c for c in keep if c != "order_number"],
    )

"""Bronze → silver: one narrow projection per table, no shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from stratamart import fixed_values as V
from stratamart.functions import cleaning as C


def silver_customers(bronze: DataFrame) -> DataFrame:
    df = C.trim_strings(bronze).withColumns({
        "cst_marital_status": C.map_codes("cst_marital_status", V.MARITAL_STATUS),
        "cst_gndr": C.map_codes("cst_gndr", V.GENDER_CODES),
    })
    return C.rename_columns(df, V.RENAME_CUSTOMERS)


def silver_products(bronze: DataFrame) -> DataFrame:
    start, end = C.ordered_range("try_cast(prd_start_dt AS date)", "try_cast(prd_end_dt AS date)")
    # withColumns reads the incoming columns throughout: the category still sees
    # the whole key, the swap sees both original dates. An end date is there after
    # the swap exactly where it was there before.
    df = C.trim_strings(bronze).withColumns({
        "cat_id": C.category_of("prd_key"),
        "prd_key": C.number_of("prd_key"),
        "prd_cost": C.default_zero("prd_cost"),
        "prd_line": C.map_codes("prd_line", V.PRODUCT_LINES),
        "prd_start_dt": start,
        "prd_end_dt": end,
        "is_current": C.as_date("prd_end_dt").isNull(),
    })
    return C.rename_columns(df, V.RENAME_PRODUCTS)


def silver_sales(bronze: DataFrame) -> DataFrame:
    dates = ["sls_order_dt", "sls_ship_dt", "sls_due_dt"]
    df = C.trim_strings(bronze).withColumns({
        **{c: C.date_code(c) for c in dates},
        "sls_price": C.repaired_price("sls_price", "sls_sales", "sls_quantity"),
    })
    return C.rename_columns(df, V.RENAME_SALES)


def silver_demographics(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    df = C.trim_strings(bronze).withColumns({
        "CID": C.strip_prefix("CID", V.ERP_CUSTOMER_PREFIX),
        "BDATE": C.null_future("BDATE", as_of),
        "GEN": C.map_codes("GEN", V.GENDER_SYNONYMS),
    })
    return C.rename_columns(df, V.RENAME_DEMOGRAPHICS)


def silver_location(bronze: DataFrame) -> DataFrame:
    df = C.trim_strings(bronze).withColumns({
        "CID": C.remove_chars("CID", "-"),
        "CNTRY": C.map_codes("CNTRY", V.COUNTRIES, ignore_case=False, passthrough=True),
    })
    return C.rename_columns(df, V.RENAME_LOCATION)


def silver_category(bronze: DataFrame) -> DataFrame:
    df = C.trim_strings(bronze).withColumns({"MAINTENANCE": C.yes_no("MAINTENANCE")})
    return C.rename_columns(df, V.RENAME_CATEGORY)


SILVER_BUILDERS = {
    "crm_cust_info": silver_customers,
    "crm_prd_info": silver_products,
    "crm_sales_details": silver_sales,
    "erp_cust_az12": silver_demographics,
    "erp_loc_a101": silver_location,
    "erp_px_cat_g1v2": silver_category,
}

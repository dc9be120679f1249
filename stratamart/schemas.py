"""Explicit schemas: no inference pass over the source files, stable key types."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec])


_STR, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_DATE, _BOOL, _DBL = T.DateType(), T.BooleanType(), T.DoubleType()

BRONZE_SCHEMAS: dict[str, T.StructType] = {
    "crm_cust_info": _struct([
        ("cst_id", _LONG), ("cst_key", _STR), ("cst_firstname", _STR),
        ("cst_lastname", _STR), ("cst_marital_status", _STR), ("cst_gndr", _STR),
        ("cst_create_date", _DATE),
    ]),
    "crm_prd_info": _struct([
        ("prd_id", _LONG), ("prd_key", _STR), ("prd_nm", _STR), ("prd_cost", _INT),
        ("prd_line", _STR), ("prd_start_dt", _DATE), ("prd_end_dt", _DATE),
    ]),
    "crm_sales_details": _struct([
        ("sls_ord_num", _STR), ("sls_prd_key", _STR), ("sls_cust_id", _LONG),
        ("sls_order_dt", _INT), ("sls_ship_dt", _INT), ("sls_due_dt", _INT),
        ("sls_sales", _INT), ("sls_quantity", _INT), ("sls_price", _INT),
    ]),
    "erp_cust_az12": _struct([("CID", _STR), ("BDATE", _DATE), ("GEN", _STR)]),
    "erp_loc_a101": _struct([("CID", _STR), ("CNTRY", _STR)]),
    "erp_px_cat_g1v2": _struct([
        ("ID", _STR), ("CAT", _STR), ("SUBCAT", _STR), ("MAINTENANCE", _STR),
    ]),
}

# What a run reads from the extracts: money with its fraction, counts of any size.
_MONEY = T.DecimalType(18, 4)
_WIDE = {"prd_cost": _MONEY, "sls_sales": _MONEY, "sls_price": _MONEY, "sls_quantity": _LONG}
EXTRACT_SCHEMAS: dict[str, T.StructType] = {
    table: _struct([(f.name, _WIDE.get(f.name, f.dataType)) for f in schema.fields])
    for table, schema in BRONZE_SCHEMAS.items()
}

# One row per check run. Explicit, so all-NULL columns and empty issue lists save.
LOG_SCHEMA: T.StructType = _struct([
    ("run_timestamp", T.TimestampType()),
    ("pipeline_name", _STR),
    ("task_name", _STR),
    ("layer", _STR),
    ("quality_score", _INT),
    ("status", _STR),
    ("total_records", _LONG),
    ("data_freshness_hours", _LONG),
    ("null_product_keys", _LONG),
    ("null_customer_keys", _LONG),
    ("outlier_count", _LONG),
    ("unique_products", _LONG),
    ("unique_customers", _LONG),
    ("unique_orders", _LONG),
    ("revenue_reconciliation_pass", _BOOL),
    ("revenue_gold", _DBL),
    ("revenue_silver", _DBL),
    ("revenue_diff_pct", _DBL),
    ("record_count_pass", _BOOL),
    ("negative_sales", _LONG),
    ("invalid_ship_dates", _LONG),
    ("invalid_due_dates", _LONG),
    ("price_calculation_errors", _LONG),
    ("orphaned_products", _LONG),
    ("orphaned_customers", _LONG),
    ("last_order_date", _DATE),
    ("data_age_days", _LONG),
    ("completeness_pct", _DBL),
    ("critical_issues", T.ArrayType(_STR)),
    ("warnings", T.ArrayType(_STR)),
    ("full_metrics", _STR),
])

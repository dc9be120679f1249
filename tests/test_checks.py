import datetime as dt

import pytest
from conftest import planned, rows
from pyspark.sql import functions as F

from stratamart import fixed_values as V
from stratamart.operators import checks
from stratamart.schemas import BRONZE_SCHEMAS

FACT = ("order_number string, product_key long, customer_key long, order_date date, "
        "ship_date date, due_date date, sales_amount int, quantity int, price double")
DAY = dt.date


def table(spark, name, n):
    """n rows with distinct keys."""
    fields = BRONZE_SCHEMAS[name].fields
    return spark.range(n).select(*[F.col("id").cast("int").cast(f.dataType).alias(f.name)
                                   if f.dataType.simpleString() != "date"
                                   else F.lit(None).cast("date").alias(f.name) for f in fields])


@pytest.mark.parametrize("name, n, status, text", [
    ("crm_cust_info", 0, V.CRITICAL, "CRITICAL: No records ingested from cust_info.csv"),
    ("crm_cust_info", 999, V.WARNING, "WARNING: Only 999 customers ingested - expected more"),
    ("crm_cust_info", 1000, V.PASS, "PASS: 1000 customer records ingested successfully"),
    ("crm_prd_info", 99, V.WARNING, "WARNING: Only 99 products ingested - expected more"),
    ("crm_prd_info", 100, V.PASS, "PASS: 100 product records ingested successfully"),
    ("erp_px_cat_g1v2", 37, V.WARNING,
     "WARNING: Only 37 product categories ingested - expected more"),
    ("erp_px_cat_g1v2", 50, V.PASS, "PASS: 50 product category records ingested successfully"),
])
def test_ingestion_tiers(spark, name, n, status, text):
    row = checks.ingestion_check({name: table(spark, name, n)}).first()
    assert (row.check_name, row.table_name, row.record_count, row.unique_keys) == (
        "File Ingestion Validation", name, n, n)
    assert (row.status, row.message) == (status, text)


def test_unique_keys_leave_nulls_out(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "cst_id long")
    assert checks.ingestion_check({"crm_cust_info": df}).first().unique_keys == 1
    approx = checks.ingestion_check({"crm_cust_info": df}, approximate=True)
    assert approx.first().unique_keys == 1


@pytest.mark.parametrize("name, pairs, status", [
    ("crm_cust_info", 0, V.PASS), ("crm_cust_info", 49, V.PASS),
    ("crm_cust_info", 50, V.WARNING), ("crm_cust_info", 99, V.WARNING),
    ("crm_cust_info", 100, V.CRITICAL),
    ("crm_prd_info", 19, V.PASS), ("crm_prd_info", 20, V.WARNING),
    ("crm_prd_info", 50, V.CRITICAL),
    ("crm_sales_details", 0, V.PASS), ("crm_sales_details", 1, V.WARNING),
    ("crm_sales_details", 10, V.CRITICAL),
    ("erp_px_cat_g1v2", 9, V.PASS), ("erp_px_cat_g1v2", 10, V.WARNING),
    ("erp_px_cat_g1v2", 25, V.CRITICAL),
])
def test_duplicate_tiers(spark, name, pairs, status):
    once = table(spark, name, 200)
    again = once.where(F.col(once.columns[0]).cast("int") < pairs)
    row = checks.duplicate_check({name: once.unionByName(again)}).first()
    assert (row.duplicate_keys, row.duplicate_records, row.status) == (pairs, 2 * pairs, status)


def test_null_keys_form_one_duplicate_group(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "cst_id long")
    row = checks.duplicate_check({"crm_cust_info": df}).first()
    assert (row.duplicate_keys, row.duplicate_records) == (1, 2)
    assert row.message == "PASS: Only 1 minor customer ID duplicates (acceptable)"


def test_null_checks(spark):
    cust = spark.createDataFrame([(1, "k", "a"), (2, None, None)],
                                 "cst_id long, cst_key string, cst_firstname string")
    prd = spark.createDataFrame([(None, "k")], "prd_id long, prd_key string")
    got = rows(checks.null_check_crm({"crm_cust_info": cust, "crm_prd_info": prd}))
    assert got == [
        (V.CHECK_NULLS, "crm_cust_info", 2, 0, 1, 1, V.WARNING),
        (V.CHECK_NULLS, "crm_prd_info", 1, 1, 0, 0, V.CRITICAL),
    ]
    loc = spark.createDataFrame([("a", None), ("b", None)], "CID string, CNTRY string")
    ids = spark.createDataFrame([("a",)], "CID string")
    got = rows(checks.null_check_erp({"erp_loc_a101": loc, "erp_cust_az12": ids}),
               "table_name", "null_cid", "null_field2", "status", "message")
    assert got == [
        ("erp_cust_az12", 0, 0, V.PASS, "PASS: No NULL values in critical fields"),
        ("erp_loc_a101", 0, 2, V.WARNING, "WARNING: 2 records with NULL country"),
    ]


def test_null_checks_on_empty_tables_pass(spark):
    empty = spark.createDataFrame([], BRONZE_SCHEMAS["erp_loc_a101"])
    row = checks.null_check_erp({"erp_loc_a101": empty}).first()
    assert (row.total_records, row.null_cid, row.status) == (0, 0, V.PASS)


@pytest.mark.parametrize("name, bronze, silver, status", [
    ("crm_cust_info", 20, 20, V.PASS), ("crm_cust_info", 20, 11, V.WARNING),
    ("crm_cust_info", 11, 20, V.WARNING), ("crm_cust_info", 20, 10, V.CRITICAL),
    ("crm_prd_info", 20, 20, V.PASS), ("crm_prd_info", 20, 1, V.WARNING),
])
def test_reconciliation_tiers(spark, name, bronze, silver, status):
    row = checks.reconciliation_check({name: spark.range(bronze)}, {name: spark.range(silver)}).first()
    assert (row.bronze_count, row.silver_count, row.diff, row.status) == (
        bronze, silver, silver - bronze, status)


def test_limits(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "ID string")
    row = checks.limit_check({"erp_px_cat_g1v2": df}).first()
    assert (row.total_records, row.duplicate_pct, row.null_pct, row.status) == (
        4, 50.0, 25.0, V.WARNING)
    empty = checks.limit_check({"erp_px_cat_g1v2": df.limit(0)}).first()
    assert (empty.total_records, empty.duplicate_pct, empty.status) == (0, 0.0, V.CRITICAL)


def fact(spark, data):
    return spark.createDataFrame(data, FACT)


@pytest.fixture()
def mixed(spark):
    d = DAY(2020, 1, 10)
    return fact(spark, [
        ("1", 1, 1, d, d, d, 100, 2, 50.0),
        ("2", None, 1, d, DAY(2020, 1, 9), d, 100, 2, 49.0),
        ("3", 2, None, d, None, DAY(2020, 1, 1), None, 2, 49.0),
        ("4", 2, 5, None, d, d, -1, 1, -1.0),
    ])


def test_fact_checks(mixed):
    assert rows(checks.null_foreign_key_check(mixed)) == [
        (V.CHECK_NULL_FKS, 4, 1, 1, V.CRITICAL)]
    assert rows(checks.negative_sales_check(mixed)) == [(V.CHECK_NEGATIVE, 4, 1, V.CRITICAL)]
    assert rows(checks.business_rules_check(mixed)) == [(V.CHECK_RULES, 1, 1, 1, V.WARNING)]


def test_price_errors_alone_do_not_warn(spark):
    d = DAY(2020, 1, 1)
    df = fact(spark, [("1", 1, 1, d, d, d, 100, 2, 10.0)])
    assert rows(checks.business_rules_check(df)) == [(V.CHECK_RULES, 0, 0, 1, V.PASS)]


def test_fact_checks_on_an_empty_fact(spark):
    empty = fact(spark, [])
    assert checks.null_foreign_key_check(empty).first().status == V.CRITICAL
    assert checks.negative_sales_check(empty).first().status == V.CRITICAL
    assert checks.business_rules_check(empty).first().status == V.WARNING
    assert checks.revenue_check(empty, empty).first().status == V.CRITICAL
    assert checks.fact_count_check(empty, empty).first().status == V.PASS


@pytest.mark.parametrize("gold, status", [
    (1_000_000, V.PASS), (1_000_099, V.PASS), (1_000_100, V.CRITICAL), (999_901, V.PASS),
    (0, V.CRITICAL),
])
def test_revenue_tolerance_is_exclusive(spark, gold, status):
    silver = fact(spark, [("1", 1, 1, None, None, None, 1_000_000, 1, 1.0)])
    row = checks.revenue_check(
        silver, fact(spark, [("1", 1, 1, None, None, None, gold, 1, 1.0)])).first()
    assert (row.diff, row.status) == (gold - 1_000_000, status)


def test_zero_silver_revenue_is_critical(spark):
    zero = fact(spark, [("1", 1, 1, None, None, None, 0, 1, 1.0)])
    row = checks.revenue_check(zero, zero).first()
    assert row.diff_pct is None and row.status == V.CRITICAL


def test_dimension_keys(spark):
    customers = spark.createDataFrame([(1,), (1,), (None,)], "customer_key long")
    products = spark.createDataFrame([(1,), (2,)], "product_key long")
    assert rows(checks.key_uniqueness_check(customers, products)) == [
        (V.CHECK_UNIQUENESS, 2, 0, V.CRITICAL)]
    assert rows(checks.key_uniqueness_check(customers.distinct(), products)) == [
        (V.CHECK_UNIQUENESS, 0, 0, V.PASS)]
    assert rows(checks.null_key_check(customers, products)) == [
        (V.CHECK_NULL_KEYS, 1, 0, V.CRITICAL)]


def test_referential_integrity_counts_distinct_known_keys(mixed, spark):
    products = spark.createDataFrame([(1,)], "product_key long")
    customers = spark.createDataFrame([(1,), (5,)], "customer_key long")
    assert rows(checks.referential_check(mixed, products, customers)) == [
        (V.CHECK_REFERENTIAL, 1, 0, V.CRITICAL)]
    all_products = spark.createDataFrame([(1,), (2,)], "product_key long")
    assert rows(checks.referential_check(mixed, all_products, customers)) == [
        (V.CHECK_REFERENTIAL, 0, 0, V.PASS)]


def test_checks_use_no_cross_join(mixed, spark):
    products = spark.createDataFrame([(1,)], "product_key long, category string".split(",")[0])
    customers = spark.createDataFrame([(1,)], "customer_key long")
    for df in (
        checks.revenue_check(mixed, mixed), checks.fact_count_check(mixed, mixed),
        checks.referential_check(mixed, products, customers),
        checks.key_uniqueness_check(customers, products),
    ):
        assert "NestedLoop" not in planned(df) and "Cartesian" not in planned(df)


def test_revenue_check_reads_only_what_it_compares(spark, mixed, tmp_path):
    mixed.write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    text = planned(checks.revenue_check(stored, stored))
    assert text.count("ReadSchema: struct<sales_amount:int>") == 2


def test_silver_referential(spark):
    sales = spark.createDataFrame(
        [("P1", 1), ("PX", 1), ("PX", 9), (None, None)], "product_number string, customer_id long")
    products = spark.createDataFrame([("P1",), ("P1",)], "product_number string")
    customers = spark.createDataFrame([(1,), (None,)], "customer_id long")
    assert rows(checks.silver_referential_check(sales, products, customers)) == [
        ("Silver Referential Integrity", 1, 2, 1, 1, V.WARNING)]


def test_type_check_counts_present_values_that_do_not_read(spark):
    df = spark.createDataFrame(
        [("1", "2020-01-01"), ("x", "2020-13-01"), (None, None)],
        "cst_id string, cst_create_date string")
    others = {n: spark.createDataFrame([], BRONZE_SCHEMAS[n]) for n in checks.TYPE_RULES}
    out = checks.type_check({**others, "crm_cust_info": df})
    got = rows(out.where("table_name = 'crm_cust_info'"), "column_name", "violations", "status")
    assert got == [("cst_create_date", 1, V.WARNING), ("cst_id", 1, V.WARNING)]


def test_standardisation_counts_labels_outside_the_set(spark):
    silver = {
        "crm_customers": spark.createDataFrame(
            [("Single", "Male"), ("single", None)], "marital_status string, gender string"),
        "crm_products": spark.createDataFrame([("Road",)], "product_line string"),
        "erp_customers_id": spark.createDataFrame([("M",)], "gender string"),
        "erp_customer_location": spark.createDataFrame([("US",), ("France",)], "country string"),
    }
    got = rows(checks.standardisation_check(silver), "table_name", "column_name", "violations")
    assert got == [
        ("crm_customers", "gender", 1), ("crm_customers", "marital_status", 1),
        ("crm_products", "product_line", 0), ("erp_customer_location", "country", 1),
        ("erp_customers_id", "gender", 1)]

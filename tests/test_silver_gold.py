import datetime as dt

import pytest
from conftest import planned, rows
from pyspark.sql import functions as F

from stratamart.operators import gold, silver
from stratamart.schemas import BRONZE_SCHEMAS

DAY = dt.date


def bronze(spark, name, data):
    return spark.createDataFrame(data, BRONZE_SCHEMAS[name])


def test_silver_customers(spark):
    df = bronze(spark, "crm_cust_info", [
        (1, " K1", "  Ann ", None, "s", " f", DAY(2020, 1, 1)),
        (None, None, None, "Bo ", " ", None, None),
    ])
    out = silver.silver_customers(df)
    assert out.columns == ["customer_id", "customer_key", "firstname", "lastname",
                           "marital_status", "gender", "created_date"]
    assert rows(out) == sorted([
        (1, "K1", "Ann", None, "Single", "Female", DAY(2020, 1, 1)),
        (None, None, None, "Bo", "n/a", "n/a", None),
    ], key=repr)


def test_silver_products_category_comes_from_the_whole_key(spark):
    df = bronze(spark, "crm_prd_info", [
        (210, "CO-RF-FR-R92B-58", "Frame ", None, "R ", DAY(2003, 7, 1), None),
        (212, "AC-HE-HL-U509-R", "Helmet", 12, "S ", DAY(2011, 7, 1), DAY(2007, 12, 28)),
    ])
    out = silver.silver_products(df)
    assert rows(out, "product_id", "category_id", "product_number", "product_name",
                "product_cost", "product_line", "start_date", "end_date", "is_current") == [
        (210, "CO_RF", "FR-R92B-58", "Frame", 0, "Road", DAY(2003, 7, 1), None, True),
        (212, "AC_HE", "HL-U509-R", "Helmet", 12, "Other Sales", DAY(2007, 12, 28),
         DAY(2011, 7, 1), False),
    ]


def test_silver_sales(spark):
    df = bronze(spark, "crm_sales_details", [
        (" SO1", "P1 ", 5, 20101229, 20110105, 20110110, 100, 4, None),
        ("SO2", "P2", 6, 0, 32154, 20101332, -9, 0, -1),
    ])
    assert rows(silver.silver_sales(df)) == [
        ("SO1", "P1", 5, DAY(2010, 12, 29), DAY(2011, 1, 5), DAY(2011, 1, 10), 100, 4, 25.0),
        ("SO2", "P2", 6, None, None, None, -9, 0, None),
    ]


def test_silver_erp_tables(spark):
    demo = silver.silver_demographics(
        bronze(spark, "erp_cust_az12", [
            ("NASAW1", DAY(2999, 1, 1), " female"), ("AW2", DAY(1980, 1, 1), None)]),
    )
    assert rows(demo, "customer_number", "birth_date", "gender") == [
        ("AW1", None, "Female"), ("AW2", DAY(1980, 1, 1), "n/a")]
    place = silver.silver_location(bronze(spark, "erp_loc_a101", [("AW-1", "US "), ("AW-2", " ")]))
    assert rows(place, "customer_number", "country") == [("AW1", "United States"), ("AW2", "n/a")]
    cats = silver.silver_category(bronze(spark, "erp_px_cat_g1v2", [
        ("AC_HE", " Accessories", "Helmets", "Yes"), ("CO_PE", "Components", "Pedals", "")]))
    assert rows(cats) == [
        ("AC_HE", "Accessories", "Helmets", True), ("CO_PE", "Components", "Pedals", None)]


@pytest.mark.parametrize("name", list(silver.SILVER_BUILDERS))
def test_silver_is_narrow_and_runs_no_python(spark, name):
    df = spark.range(1).select(*[
        F.lit(None).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMAS[name].fields])
    text = planned(silver.SILVER_BUILDERS[name](df))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_lineage_columns_pass_through_silver(spark):
    df = bronze(spark, "erp_loc_a101", [("AW-1", "DE")]).withColumn("_source_table", F.lit("x"))
    assert silver.silver_location(df).columns == ["customer_number", "country", "_source_table"]


@pytest.fixture()
def crm(spark):
    return spark.createDataFrame([
        ("AW1", 11, "Ann", "A", "Single", "Male", DAY(2020, 1, 1)),
        ("AW2", 10, "Bob", "B", "Married", "n/a", DAY(2020, 1, 2)),
        ("AW2", 10, "Bob", "B", "Married", "n/a", DAY(2020, 1, 2)),
        ("AW3", None, "Cy", "C", "n/a", "n/a", None),
        (None, 12, "Di", "D", "n/a", "Female", None),
    ], "customer_key string, customer_id long, firstname string, lastname string, "
       "marital_status string, gender string, created_date date")


@pytest.fixture()
def erp(spark):
    demo = spark.createDataFrame(
        [("AW1", DAY(1980, 1, 1), "Female"), ("AW2", None, "Female"), (None, None, "Male")],
        "customer_number string, birth_date date, gender string")
    place = spark.createDataFrame(
        [("AW1", "Germany"), ("AW2", "France"), ("AW2", "Spain")],
        "customer_number string, country string")
    return demo, place


EXPECTED_CUSTOMERS = [
    (1, None, "Cy", "C", None, "n/a", "n/a", None, None),
    (2, 10, "Bob", "B", "France", "Married", "Female", None, DAY(2020, 1, 2)),
    (3, 10, "Bob", "B", "France", "Married", "Female", None, DAY(2020, 1, 2)),
    (4, 10, "Bob", "B", "Spain", "Married", "Female", None, DAY(2020, 1, 2)),
    (5, 10, "Bob", "B", "Spain", "Married", "Female", None, DAY(2020, 1, 2)),
    (6, 11, "Ann", "A", "Germany", "Single", "Male", DAY(1980, 1, 1), DAY(2020, 1, 1)),
    (7, 12, "Di", "D", None, "n/a", "Female", None, None),
]


@pytest.mark.parametrize("options", [{}, {"rows_per_partition": 2}])
def test_dim_customers_keeps_fan_out_and_numbers_from_one(crm, erp, options, no_broadcast):
    out = gold.dim_customers(crm, *erp, **options)
    assert out.columns[0] == "customer_key"
    assert rows(out) == EXPECTED_CUSTOMERS


@pytest.fixture()
def products(spark):
    return spark.createDataFrame([
        (1, "P1", "old", "C1", "Road", DAY(2010, 1, 1), DAY(2011, 1, 1)),
        (2, "P1", "new", "C1", "Road", DAY(2012, 1, 1), None),
        (3, "P2", "two", "C9", "n/a", DAY(2010, 1, 1), None),
    ], "product_id long, product_number string, product_name string, category_id string, "
       "product_line string, start_date date, end_date date")


@pytest.fixture()
def categories(spark):
    return spark.createDataFrame(
        [("C1", "Cycles", "Touring Cycles", True)],
        "category_id string, category string, subcategory string, maintenance_flag boolean")


def test_dim_products(products, categories):
    every = gold.dim_products(products, categories)
    assert rows(every, "product_key", "product_id", "category") == [
        (1, 1, "Cycles"), (2, 3, None), (3, 2, "Cycles")]
    current = gold.dim_products(products, categories, current_only=True)
    assert rows(current, "product_key", "product_id") == [(1, 3), (2, 2)]


@pytest.fixture()
def sales(spark):
    return spark.createDataFrame([
        ("SO1", "P1", 10, 5), ("SO2", "P2", 11, None), ("SO3", "PX", 10, 0),
        ("SO4", "P1", -1, 7), ("SO5", "P1", 10, -3), ("SO6", None, None, 1),
    ], "order_number string, product_number string, customer_id long, sales_amount int").withColumns({
        "order_date": F.lit(None).cast("date"), "ship_date": F.lit(None).cast("date"),
        "due_date": F.lit(None).cast("date"), "quantity": F.lit(1), "price": F.lit(1.0)})


def test_fact_sales(sales, products, categories, crm, erp, no_broadcast):
    fact = gold.fact_sales(
        sales, gold.dim_products(products, categories), gold.dim_customers(crm, *erp))
    assert fact.columns == ["order_number", "product_key", "customer_key", "order_date",
                            "ship_date", "due_date", "sales_amount", "quantity", "price"]
    assert rows(fact, "order_number", "product_key", "customer_key", "sales_amount") == [
        ("SO1", 3, 5, 5),        # newest product version, greatest customer key
        ("SO2", 2, 6, None),     # missing amount is kept
        ("SO3", None, 5, 0),     # unknown product
        ("SO4", 3, None, 7),     # unknown customer
        ("SO6", None, None, 1),  # missing keys match nothing, not even the NULL id
    ]


def test_fact_rows_are_filtered_before_the_lookups(sales, products, categories, crm, erp):
    fact = gold.fact_sales(
        sales, gold.dim_products(products, categories), gold.dim_customers(crm, *erp))
    text = planned(fact)
    assert text.rindex("Filter (isnull(sales_amount") > text.rindex("LeftOuter")
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text

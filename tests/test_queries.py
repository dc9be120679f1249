"""Every registered query against its SQL, and what its plan may not contain."""

import pytest
from conftest import TEST_DATA, planned

import __spark_entry__ as entry_points
from catalogue.oracle import ORACLE_SQL
from catalogue import queries
from catalogue.queries import QUERIES, Model
from check_oracle import compare, oracle_connection
from stratamart.operators import joins
from stratamart.operators.keys import number_rows
from stratamart.operators.silver import silver_sales
from stratamart.plans import marts
from stratamart.staging import stage


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(TEST_DATA)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, TEST_DATA) == ""


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["country", "lines", "revenue"] and df.count() > 0


@pytest.mark.parametrize("name", [
    "silver_crm_sales", "gold_fact_sales", "mart_revenue_by_country", "mart_customer_ltv",
    "dq_gold_referential", "dq_score_gold", "dq_silver_referential", "quality_trend",
])
def test_plans_have_no_python_and_no_cross_joins(spark, name):
    text = planned(entry_points.queries()[name](spark, TEST_DATA))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_scan_reads_only_what_silver_sales_needs(spark):
    df = silver_sales(Model(spark, TEST_DATA).bronze("crm_sales_details"))
    text = planned(df.select("order_number", "sales_amount"))
    assert "l_quantity" not in text and "l_shipdate" not in text


def test_marts_sum_before_they_join(spark, no_broadcast):
    fact = spark.createDataFrame(
        [("1", 1, 1, None, 5)],
        "order_number string, product_key long, customer_key long, order_date date, "
        "sales_amount int")
    who = spark.createDataFrame(
        [(1, 1, "x", "y")], "customer_key long, customer_id long, country string, gender string")
    text = planned(marts.revenue_by_country(fact, who))
    assert text.rindex("partial_sum(sales_amount") > text.index("SortMergeJoin")


def test_top_products_per_category_prunes_before_the_shuffle(spark):
    fact = spark.createDataFrame([(1, 5)], "product_key long, sales_amount int")
    names = spark.createDataFrame(
        [(1, "p", "n", "c")],
        "product_key long, product_number string, product_name string, category string")
    assert "WindowGroupLimit" in planned(marts.top_products_by_category(fact, names))
    assert "TakeOrderedAndProject" in planned(marts.top_products(fact, names))


def test_segments_agree_on_both_ways_of_selection(spark):
    fact = spark.range(500).selectExpr(
        "string(id) AS order_number", "id % 37 AS customer_key",
        "date_add(DATE '2020-01-01', int(id * 7 % 300)) AS order_date",
        "int(id * 13 % 101) AS sales_amount")
    who = spark.range(37).selectExpr("id AS customer_key", "string(id % 3) AS country")
    one = marts.customer_segments(fact, who)
    many = marts.customer_segments(fact, who, few=5)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))


def test_surrogate_keys_run_from_one_to_n_without_gaps(spark):
    lines = spark.read.parquet(f"{TEST_DATA}/lineitem.parquet").select("l_partkey", "l_shipdate")
    keyed = number_rows(lines, ["l_partkey"], "key", rows_per_partition=500)
    n = lines.count()
    low, high, distinct = keyed.selectExpr("min(key)", "max(key)", "count(DISTINCT key)").first()
    assert (low, high, distinct) == (1, n, n)


@pytest.fixture()
def everything_is_hot(monkeypatch, no_broadcast):
    """Joins shuffle, and keys count as hot from a few rows on."""
    for function, name, value in [
        (joins.find_hot_keys, "hot_rows", 3), (joins.find_hot_keys, "hot_share", 0.0),
        (joins.find_hot_keys, "rows_per_salt", 2), (joins.hot_keys_for, "small_left", 0),
        (joins.hot_right_keys, "small_right", 0),
    ]:
        monkeypatch.setitem(function.__kwdefaults__, name, value)


@pytest.mark.parametrize("name", ["gold_dim_customers", "gold_dim_products", "gold_fact_sales"])
def test_the_model_is_the_same_with_every_lookup_salted(spark, duck, name, everything_is_hot):
    if name == "gold_fact_sales":  # dimensions are staged with their numbers; see test_joins
        assert "_salt" in planned(entry_points.queries()[name](spark, TEST_DATA))
    assert compare(spark, duck, name, TEST_DATA) == ""


def test_what_is_read_twice_is_written_once_with_the_columns_read(spark, monkeypatch):
    written = []

    def noted(df, label):
        written.append((label, df.columns))
        return stage(df, label)

    monkeypatch.setattr(queries, "stage", noted)
    QUERIES["dq_gold_metric_consistency"](spark, TEST_DATA)
    assert written == [("fact", ["product_key", "sales_amount"])]
    written.clear()
    QUERIES["quality_gate"](spark, TEST_DATA)
    assert [label for label, _ in written] == ["sales"]

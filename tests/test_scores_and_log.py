import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratamart import fixed_values as V
from stratamart.operators import gold, quality_log, scoring
from stratamart.schemas import LOG_SCHEMA


@pytest.mark.parametrize("counts, score, status, issues, warnings", [
    ((0, 0, 0), 0, V.CRITICAL, ["No records ingested from any CRM source file"], []),
    ((0, 5, 5), 20, V.CRITICAL, ["No customer records ingested"], []),
    ((5, 0, 0), 30, V.CRITICAL, ["No product records ingested"], []),
    ((5, 5, 0), 40, V.CRITICAL, ["No sales records ingested"], []),
    ((999, 99, 999), 80, V.WARNING, [],
     ["Low customer count: 999", "Low product count: 99", "Low sales count: 999"]),
    ((1000, 99, 1000), 95, V.WARNING, [], ["Low product count: 99"]),
    ((1000, 100, 1000), 100, V.PASS, [], []),
])
def test_bronze_crm_score(spark, counts, score, status, issues, warnings):
    row = scoring.bronze_crm_score(*[spark.range(n) for n in counts]).first()
    assert (row.quality_score, row.status) == (score, status)
    assert (row.critical_issues, row.warnings) == (issues, warnings)
    c, p, s = counts
    assert row.total_records == sum(counts)
    assert (row.unique_customers, row.unique_products, row.unique_orders) == counts
    assert row.completeness_pct == (100.0 if sum(counts) else 0.0)
    assert row.full_metrics == (
        f"Bronze CRM Quality: {sum(counts)} total records "
        f"({c} customers, {p} products, {s} sales)")


@pytest.mark.parametrize("counts, score, status", [
    ((0, 0, 0), 0, V.CRITICAL), ((0, 1, 1), 20, V.CRITICAL), ((1, 0, 1), 30, V.CRITICAL),
    ((1, 1, 0), 40, V.CRITICAL), ((49, 1, 9), 80, V.WARNING), ((50, 1, 9), 90, V.WARNING),
    ((50, 1, 10), 100, V.PASS),
])
def test_bronze_erp_score(spark, counts, score, status):
    row = scoring.bronze_erp_score(*[spark.range(n) for n in counts]).first()
    assert (row.quality_score, row.status) == (score, status)


@pytest.mark.parametrize("bronze, silver, score, status, pct", [
    (4, 4, 100, V.PASS, 100.0), (4, 3, 85, V.WARNING, 75.0), (0, 0, 100, V.PASS, 0.0),
    (0, 2, 85, V.WARNING, 0.0),
])
def test_silver_score(spark, bronze, silver, score, status, pct):
    row = scoring.silver_score(spark.range(bronze), spark.range(silver), "crm_cust_info").first()
    assert (row.quality_score, row.status, row.completeness_pct) == (score, status, pct)
    assert row.full_metrics == f"Silver CRM Customers: {silver} from {bronze} Bronze"


@pytest.mark.parametrize("customers, products, score, status, issues, warnings", [
    (100, 50, 100, V.PASS, 0, 0), (99, 50, 90, V.WARNING, 0, 1), (99, 49, 80, V.WARNING, 0, 2),
    (0, 50, 0, V.CRITICAL, 1, 1), (0, 0, 0, V.CRITICAL, 2, 2),
])
def test_dimension_score_stays_within_bounds(
    spark, customers, products, score, status, issues, warnings
):
    row = scoring.dimension_score(spark.range(customers), spark.range(products)).first()
    assert (row.quality_score, row.status) == (score, status)
    assert (len(row.critical_issues), len(row.warnings)) == (issues, warnings)


FACT = ("order_number string, product_key long, customer_key long, order_date date, "
        "ship_date date, due_date date, sales_amount int, quantity int, price double")


def sold(spark, *amounts, product=1, customer=1):
    return spark.createDataFrame(
        [(str(i), product, customer, None, None, None, a, 1, 1.0)
         for i, a in enumerate(amounts)], FACT)


def test_fact_score(spark):
    good = sold(spark, 100, 200)
    row = scoring.fact_score(good, good).first()
    assert (row.quality_score, row.status, row.critical_issues) == (100, V.PASS, [])
    assert row.revenue_reconciliation_pass and row.full_metrics == (
        "Gold Fact Sales: 2 records, $300.00 revenue")

    row = scoring.fact_score(good, sold(spark, 100, product=None, customer=None)).first()
    assert (row.quality_score, row.status) == (10, V.CRITICAL)
    assert row.critical_issues == [
        "Record count mismatch: Gold 1 != Silver 2", "Revenue mismatch: 66.6667% difference",
        "1 records with null product_key", "1 records with null customer_key"]

    row = scoring.fact_score(sold(spark, -5), sold(spark, -5, product=None)).first()
    assert (row.quality_score, row.status) == (80, V.WARNING)


def test_fact_score_at_the_exact_tolerance(spark):
    row = scoring.fact_score(sold(spark, 1_000_000), sold(spark, 1_000_100)).first()
    assert row.quality_score == 100 and row.revenue_reconciliation_pass is False


def test_fact_score_of_empty_tables(spark):
    row = scoring.fact_score(sold(spark), sold(spark)).first()
    assert row.quality_score == 100 and row.revenue_gold is None
    assert row.revenue_reconciliation_pass is None and row.negative_sales == 0


def test_orphans_are_logged(spark):
    known = spark.createDataFrame([(2,)], "product_key long")
    people = spark.createDataFrame([(1,)], "customer_key long")
    fact = sold(spark, 1)
    row = scoring.fact_score(fact, fact, known, people).first()
    assert (row.orphaned_products, row.orphaned_customers) == (1, 0)


def test_orphans_and_null_keys_are_measured_together(spark):
    """A dimension that holds a key twice adds nothing."""
    fact = sold(spark, 1, 2, product=None).unionByName(sold(spark, 3, 4, 5, product=7, customer=8))
    known = spark.createDataFrame([(7,), (7,), (None,)], "product_key long")
    people = spark.createDataFrame([(1,), (1,)], "customer_key long")
    row = scoring.fact_score(fact, fact, known, people).first()
    assert (row.null_product_keys, row.null_customer_keys, row.null_keys) == (2, 0, 2)
    assert (row.orphaned_products, row.orphaned_customers) == (0, 1)
    assert row.gold_count == 5 and row.revenue_gold == 15
    empty = scoring.fact_score(sold(spark), sold(spark), known, people).first()
    assert (empty.null_product_keys, empty.orphaned_customers) == (0, 0)


def test_a_planned_fact_is_looked_up_once_per_key(spark):
    """Only counts of each key need a lookup, so no other column goes through one."""
    products = spark.createDataFrame([("p", 1)], "product_number string, product_key long")
    customers = spark.createDataFrame([(1, 1)], "customer_id long, customer_key long")
    sales = sold(spark, 1, 2).selectExpr("*", "order_number AS product_number", "product_key AS customer_id")
    fact = gold.fact_sales(sales.drop("product_key", "customer_key"), products, customers)
    log = quality_log.log_row(scoring.fact_score(sales, fact, products, customers), "t", "GOLD")
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 3  # two lookups, one against the known keys
    assert log.first().total_records == 2


def test_log_row_has_the_log_schema_and_defaults(spark):
    score = scoring.silver_score(spark.range(1), spark.range(1), "crm_prd_info")
    out = quality_log.log_row(score, "task", "SILVER", pipeline="p")
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in LOG_SCHEMA]
    row = out.first()
    assert row.run_timestamp is not None and row.pipeline_name == "p"
    assert row.outlier_count == 0 and row.revenue_gold is None and row.critical_issues == []


def test_log_appends_rows_without_losing_any(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS log_test")
    table = "log_test.quality"
    for n in (1, 2):
        score = scoring.silver_score(spark.range(n), spark.range(1), "crm_prd_info")
        quality_log.append_log(quality_log.log_row(score, f"t{n}", "SILVER"), table)
    assert rows(spark.table(table), "task_name", "quality_score") == [("t1", 100), ("t2", 85)]


def test_log_failure_is_raised(spark):
    score = scoring.silver_score(spark.range(1), spark.range(1), "crm_prd_info")
    row = quality_log.log_row(score, "t", "SILVER")
    with pytest.raises(Exception, match="no_such_schema"):
        quality_log.append_log(row, "no_such_schema.log")


@pytest.mark.parametrize("silver, raises", [(0, True), (100, False)])
def test_gate(spark, silver, raises):
    score = scoring.dimension_score(spark.range(silver), spark.range(50))
    row = quality_log.log_row(score, V.TASK_GOLD_DIMENSIONS, "GOLD")
    assert quality_log.gate_verdict(row).first().blocked is raises
    quality_log.enforce_gate(row, blocking=False)
    if raises:
        with pytest.raises(quality_log.QualityGateError, match="No customer dimension records"):
            quality_log.enforce_gate(row)
    else:
        quality_log.enforce_gate(row)


def test_quality_trend(spark):
    log = spark.createDataFrame(
        [("p", "a", "GOLD", 1, 100), ("p", "a", "GOLD", 2, 60), ("p", "b", "GOLD", 1, 90)],
        "pipeline_name string, task_name string, layer string, t int, quality_score int",
    ).withColumns({"run_timestamp": F.timestamp_seconds("t"), "status": F.lit("s")})
    got = rows(quality_log.quality_trend(log), "task_name", "quality_score", "previous_score",
               "score_change", "alert", "is_latest")
    assert got == [("a", 100, None, None, False, False), ("a", 60, 100, -40, True, True),
                   ("b", 90, None, None, True, True)]

"""Registered queries: name → function of (spark, folder of the test tables)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import feeds
from catalogue.raw_views import RAW_VIEWS, raw_table, sales_lines, typed
from stratamart import fixed_values as V
from stratamart.operators import checks, distinct_counts, gold, quality_log, scoring
from stratamart.operators.keys import latest_per_key, number_rows
from stratamart.operators.silver import SILVER_BUILDERS, silver_demographics, silver_sales
from stratamart.operators.registry import KeyRegistry
from stratamart.plans import marts
from stratamart.plans.incremental import IncrementalGold
from stratamart.schemas import BRONZE_SCHEMAS, LOG_SCHEMA
from stratamart.sources import csv_files, tables
from stratamart.staging import new_path, stage
from stratamart.streaming import ingest, upsert

CRM = ("crm_cust_info", "crm_prd_info", "crm_sales_details")
ERP = ("erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2")
AS_OF = dt.date(2026, 1, 1)


class Model:
    """The layers over one folder of test tables, planned where they are asked for.

    Plans are kept for the one query that made the model; no rows are cached.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def bronze(self, name: str) -> DataFrame:
        return self._once(f"bronze {name}", lambda: raw_table(self.read, name))

    def read(self, name: str) -> DataFrame:
        return self._once(f"file {name}", lambda: _table(self.spark, self.sf_dir, name))

    def bronzes(self, names) -> dict[str, DataFrame]:
        return {n: self.bronze(n) for n in names}

    def silver(self, name: str) -> DataFrame:
        build = SILVER_BUILDERS[name]
        options = {"as_of": AS_OF} if build is silver_demographics else {}
        return self._once(f"silver {name}", lambda: build(self.bronze(name), **options))

    def silvers(self, names=tuple(RAW_VIEWS)) -> dict[str, DataFrame]:
        return {V.SILVER_TABLES[n]: self.silver(n) for n in names}

    @property
    def sales(self) -> DataFrame:
        return self.silver("crm_sales_details")

    @property
    def dim_customers(self) -> DataFrame:
        return self._once("customers", lambda: gold.dim_customers(
            self.silver("crm_cust_info"), self.silver("erp_cust_az12"),
            self.silver("erp_loc_a101"),
        ))

    def _products(self, current_only: bool) -> DataFrame:
        return gold.dim_products(
            self.silver("crm_prd_info"), self.silver("erp_px_cat_g1v2"), current_only
        )

    @property
    def dim_products(self) -> DataFrame:
        return self._once("products", lambda: self._products(False))

    @property
    def dim_products_current(self) -> DataFrame:
        return self._once("current", lambda: self._products(True))

    @property
    def fact(self) -> DataFrame:
        return self._once("fact", lambda: gold.fact_sales(
            self.sales, self.dim_products, self.dim_customers))

    def fact_table(self, *columns: str) -> DataFrame:
        """Columns of the fact written once, for queries that read them more than once."""
        return self._once(
            f"fact table {columns}", lambda: stage(self.fact.select(*columns), "fact"))

    def write_sales(self) -> None:
        """Silver sales written once; what is planned over them from then on reads the rows."""
        name = "silver crm_sales_details"
        self._made[name] = self._once("sales table", lambda: stage(self.sales, "sales"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- silver -------------------------------------------------------------------

def _silver(name: str):
    return lambda spark, sf_dir: Model(spark, sf_dir).silver(name)


# --- keys and dedup at row scale ----------------------------------------------

def latest_per_key_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderstatus", "o_totalprice",
    )
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def surrogate_key_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_partkey", "l_orderkey",
        "l_linenumber",
    )
    return number_rows(lines, ["l_shipdate", "l_partkey"], "line_key")


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = Model(spark, sf_dir).sales
    return tables.preview(
        sales, ["order_number", "product_number", *[
            c for c in sales.columns if c not in ("order_number", "product_number")
        ]],
    )


# --- checks -------------------------------------------------------------------

def dq_gold_referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact against the whole dimensions it was built from."""
    m = Model(spark, sf_dir)
    return checks.referential_check(m.fact, m.dim_products, m.dim_customers)


def dq_gold_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of 50 or more units get product keys, those shipped in May customer keys, that no
    dimension has."""
    m = Model(spark, sf_dir)
    fact = m.fact.withColumns({
        "product_key": F.expr("CASE WHEN quantity >= 50 THEN -product_key ELSE product_key END"),
        "customer_key": F.expr(
            "CASE WHEN month(ship_date) = 5 THEN -customer_key ELSE customer_key END"),
    })
    return checks.referential_check(fact, m.dim_products, m.dim_customers)


def dq_dim_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    return (
        checks.dimension_completeness_check(
            m.silver("crm_cust_info"), m.dim_customers, "customer_id", "dim_customers")
        .unionByName(checks.dimension_completeness_check(
            m.silver("crm_prd_info"), m.dim_products, "product_id", "dim_products"))
        .unionByName(checks.dimension_completeness_check(
            m.silver("crm_prd_info"), m.dim_products_current, "product_id",
            "dim_products_current"))
    )


def _readable(rows: DataFrame) -> DataFrame:
    """Log rows without the run time, issue lists as text."""
    return rows.drop("run_timestamp").withColumns({
        "critical_issues": F.array_join("critical_issues", "; "),
        "warnings": F.array_join("warnings", "; "),
    })


def _bronze_log(m: Model) -> DataFrame:
    crm = scoring.bronze_crm_score(*m.bronzes(CRM).values())
    erp = scoring.bronze_erp_score(*m.bronzes(ERP).values())
    return quality_log.log_row(crm, V.TASK_BRONZE_CRM, "BRONZE").unionByName(
        quality_log.log_row(erp, V.TASK_BRONZE_ERP, "BRONZE")
    )


def _silver_log(m: Model) -> DataFrame:
    rows = [
        quality_log.log_row(
            scoring.silver_score(m.bronze(name), m.silver(name), name), task, "SILVER"
        )
        for name, (task, _) in V.SILVER_TASKS.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def _gold_log(m: Model) -> DataFrame:
    m.write_sales()
    dims = scoring.dimension_score(m.dim_customers, m.dim_products)
    fact = scoring.fact_score(m.sales, m.fact, m.dim_products, m.dim_customers)
    return quality_log.log_row(dims, V.TASK_GOLD_DIMENSIONS, "GOLD").unionByName(
        quality_log.log_row(fact, V.TASK_GOLD_FACT, "GOLD")
    )


def quality_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each layer's rows appended to one log table, then read back."""
    m = Model(spark, sf_dir)
    schema = f"monitoring_{uuid.uuid4().hex[:12]}"
    tables.create_schemas(
        spark, {schema: V.LAYER_SCHEMAS["monitoring"]}, location=new_path(spark, "log")
    )
    log = f"{schema}.data_quality_log"
    m.write_sales()
    for rows in (_bronze_log(m), _silver_log(m), _gold_log(m)):
        quality_log.append_log(rows, log)
    return _readable(spark.table(log).select(LOG_SCHEMA.fieldNames()))


def quality_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order month, as if each month's sales had been loaded and checked.

    Undated sales are a run without a date, before all others.
    """
    m = Model(spark, sf_dir)
    scored = scoring.fact_score_by_month(m.sales, m.fact)
    log = quality_log.log_row(
        scored, V.TASK_GOLD_FACT, "GOLD", run_timestamp="month"
    )
    return quality_log.quality_trend(log).withColumn(
        "run_date", F.col("run_timestamp").cast("date")
    ).drop("run_timestamp")


# --- sources, sinks, catalog --------------------------------------------------

def _write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def _as_text(df: DataFrame, name: str) -> DataFrame:
    cells = [F.coalesce(F.col(f.name).cast(f.dataType).cast("string"), F.lit("<null>"))
             for f in BRONZE_SCHEMAS[name].fields]
    return df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *cells).alias("row_text"))


def bronze_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six sources written as CSV, ingested into bronze tables, read back whole."""
    m, root = Model(spark, sf_dir), new_path(spark, "csv")
    for name in RAW_VIEWS:
        _write_csv(m.bronze(name), f"{root}/{V.SOURCE_FILES[name]}")
    prefix = f"csv_{uuid.uuid4().hex[:12]}_"
    tables.create_schemas(spark, prefix=prefix, location=new_path(spark, "tables"))
    out = []
    for name in RAW_VIEWS:
        target = f"{prefix}bronze.{name}"
        tables.save_table(csv_files.read_source(spark, root, name, checked=True), target)
        out.append(_as_text(
            tables.read_table(spark, target).where(F.col("_source_table") == name), name
        ))
    result = out[0]
    for df in out[1:]:
        result = result.unionByName(df)
    return result


def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales written as CSV, columns in another order, some values that do not fit; the rejects."""
    turn = F.pmod(F.col("l_orderkey"), F.lit(7))
    count = F.col("l_quantity").cast("long").cast("string")
    lines = _table(spark, sf_dir, "lineitem").select(
        F.when(turn == 1, F.concat(count, F.lit(".5"))).when(turn == 2, F.lit("n/a"))
        .otherwise(count).alias("sls_quantity"),
        F.when(turn == 3, F.lit("3000000000")).otherwise(F.lit("12")).alias("sls_price"),
        F.when(turn == 4, F.lit("")).otherwise(F.lit("7")).alias("sls_sales"),
        F.concat(F.lit("SO"), "l_orderkey").alias("sls_ord_num"),
        F.col("l_partkey").cast("string").alias("sls_prd_key"),
        *(F.lit("20240101").alias(c) for c in ("sls_due_dt", "sls_ship_dt", "sls_order_dt")),
        F.lit("1").alias("sls_cust_id"))
    root, name = new_path(spark, "csv"), "crm_sales_details"
    _write_csv(lines, f"{root}/{V.SOURCE_FILES[name]}")
    narrow = BRONZE_SCHEMAS[name]
    return csv_files.rejects(
        csv_files.read_source(spark, root, name, checked=True, schema=narrow), name)


def bronze_reject_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales from a folder for each return flag, money with fractions; rejects traced to their file."""
    turn = F.pmod(F.col("l_orderkey"), F.lit(7))
    lines = _table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("SO"), "l_orderkey").alias("sls_ord_num"),
        F.col("l_partkey").cast("string").alias("sls_prd_key"), F.lit("1").alias("sls_cust_id"),
        *(F.lit("20240101").alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")),
        F.when(turn == 1, F.lit("12.34567")).otherwise(F.lit("12.50")).alias("sls_sales"),
        F.when(turn == 2, F.lit("1.5")).otherwise(F.lit("3000000000")).alias("sls_quantity"),
        F.when(turn == 3, F.lit("n/a")).otherwise(F.lit("0.25")).alias("sls_price"),
        F.col("l_returnflag").alias("flag"))
    root, name = new_path(spark, "csv"), "crm_sales_details"
    lines.write.option("header", "true").partitionBy("flag").csv(f"{root}/{V.SOURCE_FILES[name]}")
    found = csv_files.rejects_by_file(csv_files.read_source(spark, root, name, checked=True), name)
    folder = F.regexp_extract("source_file", "/flag=([^/]*)/[^/]*$", 1)
    # A folder holds as many files as tasks wrote to it, so files are summed up.
    return found.groupBy("table_name", folder.alias("folder"), "column_name").agg(
        F.sum("rejected").alias("rejected"))


def distinct_over_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct sales keys over loads by return flag from the loads' sketches, beside exact ones.

    The last load is recorded again and counts once.
    """
    m, path, name = Model(spark, sf_dir), new_path(spark, "sketches"), "crm_sales_details"
    lines = stage(typed(
        sales_lines(m.read("lineitem"), m.read("orders"), "l_returnflag AS flag"), name, "flag"), "loads")
    keys = [["sls_ord_num"], ["sls_ord_num", "sls_prd_key"], ["sls_cust_id"]]
    for load, flag in ((0, "A"), (1, "N"), (2, "R"), (2, "R")):
        loaded = {name: lines.where(F.col("flag") == flag)}
        distinct_counts.record_load(
            distinct_counts.load_sketches(loaded, {name: keys}, load), path)
    exact = lines.agg(*[F.count_distinct(*key).alias(",".join(key)) for key in keys])
    exact = exact.unpivot([], exact.columns, "key_columns", "unique_keys")
    return distinct_counts.distinct_counts(spark.read.parquet(path)).join(exact, "key_columns").select(
        "table_name", "key_columns", "loads", "row_count", "unique_keys",
        (F.abs(F.col("distinct_keys") - F.col("unique_keys")) <= F.col("error_bound")).alias("within_bound"))


def counted_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and silver saved with their rows counted in the writes; reconciled from the counts."""
    m = Model(spark, sf_dir)
    prefix = f"cnt_{uuid.uuid4().hex[:12]}_"
    tables.create_schemas(spark, prefix=prefix, location=new_path(spark, "tables"))
    counts = {}
    for name in RAW_VIEWS:
        bronze, silver = f"{prefix}bronze.{name}", f"{prefix}silver.{V.SILVER_TABLES[name]}"
        written = tables.save_counted(m.bronze(name), bronze)
        build = SILVER_BUILDERS[name]
        options = {"as_of": AS_OF} if build is silver_demographics else {}
        cleaned = build(tables.read_table(spark, bronze), **options)
        counts[name] = checks.known_counts(spark, written, tables.save_counted(cleaned, silver))
    return checks.reconciliation_of(counts)


def catalog_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas created, silver tables saved in them, one dropped again, all of it verified."""
    m = Model(spark, sf_dir)
    prefix = f"cat_{uuid.uuid4().hex[:12]}_"
    tables.use_catalog(spark, "spark_catalog")
    schemas = tables.create_schemas(spark, prefix=prefix, location=new_path(spark, "tables"))
    for name, df in m.silvers().items():
        tables.save_table(df, f"{prefix}silver.{name}", overwrite_schema=True)
    tables.drop_table(spark, f"{prefix}silver.erp_product_category")
    counts = [
        tables.query(
            spark, "SELECT 'silver' AS layer, :name AS table_name, count(*) AS n FROM {t}",
            {"name": t.name}, t=tables.read_table(spark, f"{prefix}silver.{t.name}"),
        )
        for t in spark.catalog.listTables(f"{prefix}silver") if not t.isTemporary
    ]
    found = counts[0]
    for df in counts[1:]:
        found = found.unionByName(df)
    per_layer = found.groupBy("layer").agg(
        F.count("*").alias("tables"), F.sum("n").alias("row_count")
    )
    status = tables.schema_status(spark, schemas).withColumn(
        "layer", F.substring("schema_name", len(prefix) + 1, 100)
    )
    return status.join(per_layer, "layer", "left").select(
        "layer", "found",
        F.coalesce("tables", F.lit(0)).alias("tables"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )


# --- streaming ----------------------------------------------------------------

def stream_bronze_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales files taken in as a stream and cleaned on the way."""
    schema = _table(spark, sf_dir, "lineitem").schema
    lines = ingest.stream_files(
        spark, sf_dir, schema, "parquet", pathGlobFilter="lineitem.parquet"
    )
    bronze = sales_lines(lines, _table(spark, sf_dir, "orders"))
    out = new_path(spark, "stream")
    ingest.ingest_stream(bronze, silver_sales, f"{out}/rows", f"{out}/state").awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a change feed by user: latest event per user, errors delete the user."""
    schema = _table(spark, sf_dir, "events").schema
    changes = ingest.stream_files(
        spark, sf_dir, schema, "parquet", pathGlobFilter="events.parquet"
    ).select(
        "user_id", "ts", "event_id", "event_type", "value",
        (F.col("event_type") == "error").alias("is_deleted"),
    )
    out, keys, sequence = new_path(spark, "changes"), ["user_id"], ["ts", "event_id"]
    upsert.start_upsert(
        changes, f"{out}/rows", f"{out}/state", keys, sequence
    ).awaitTermination()
    return upsert.current_rows(
        spark, f"{out}/rows", keys, sequence, "is_deleted"
    ).select("user_id", "event_id", "event_type", "value")


def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after three batches of changes, some of them late or deletions."""
    m = Model(spark, sf_dir)
    model = IncrementalGold(
        spark, new_path(spark, "gold"), m.silver("erp_cust_az12"), m.silver("erp_loc_a101"),
        m.silver("erp_px_cat_g1v2"), sales_keys=["order_number", "line_id"], buckets=8)
    batches = zip(feeds.customer_batches(m.read), feeds.product_batches(m.read), feeds.sales_batches(m.read))
    for number, (customers, products, sales) in enumerate(batches):
        model.apply(number, customers=customers, products=products, sales=sales)
    return model.fact_sales()


def stable_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' customers and dates registered in two batches: old keys stay, new ones follow."""
    orders = _table(spark, sf_dir, "orders").select(
        F.expr("CASE WHEN o_custkey % 31 <> 5 THEN o_custkey END").alias("customer"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"), "o_orderkey")
    registry = KeyRegistry(spark, new_path(spark, "keys"), ["customer", "month"], "visit_key")
    registry.assign(orders.where("o_orderkey % 10 <> 1"), 0)
    registry.assign(orders, 1)
    return registry.keys(orders)


def _with(make: Callable[[Model], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(Model(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_crm_customers": _silver("crm_cust_info"),
    "silver_crm_products": _silver("crm_prd_info"),
    "silver_crm_sales": _silver("crm_sales_details"),
    "silver_erp_customers": _silver("erp_cust_az12"),
    "silver_erp_location": _silver("erp_loc_a101"),
    "silver_erp_category": _silver("erp_px_cat_g1v2"),
    "gold_dim_customers": _with(lambda m: m.dim_customers),
    "gold_dim_products": _with(lambda m: m.dim_products),
    "gold_dim_products_current": _with(lambda m: m.dim_products_current),
    "gold_fact_sales": _with(lambda m: m.fact),
    "latest_per_key": latest_per_key_orders,
    "surrogate_key_lineitem": surrogate_key_lineitem,
    "preview_limit": preview_limit,
    "dq_bronze_crm_ingestion": _with(lambda m: checks.ingestion_check(m.bronzes(CRM))),
    "dq_bronze_erp_ingestion": _with(lambda m: checks.ingestion_check(m.bronzes(ERP))),
    "dq_bronze_crm_duplicates": _with(lambda m: checks.duplicate_check(m.bronzes(CRM))),
    "dq_bronze_erp_duplicates": _with(lambda m: checks.duplicate_check(m.bronzes(ERP))),
    "dq_bronze_crm_nulls": _with(lambda m: checks.null_check_crm(m.bronzes(CRM))),
    "dq_bronze_erp_nulls": _with(lambda m: checks.null_check_erp(m.bronzes(ERP))),
    "dq_bronze_limits": _with(lambda m: checks.limit_check(m.bronzes(RAW_VIEWS))),
    "dq_silver_reconciliation": _with(lambda m: checks.reconciliation_check(
        m.bronzes(RAW_VIEWS), {n: m.silver(n) for n in RAW_VIEWS})),
    "dq_silver_referential": _with(lambda m: checks.silver_referential_check(
        m.sales, m.silver("crm_prd_info"), m.silver("crm_cust_info"))),
    "dq_silver_business_rules": _with(lambda m: checks.silver_rules_check(m.sales)),
    "dq_silver_standardisation": _with(lambda m: checks.standardisation_check(m.silvers())),
    "dq_silver_nulls": _with(lambda m: checks.silver_null_check(m.silvers())),
    "dq_silver_types": _with(lambda m: checks.type_check(m.bronzes(RAW_VIEWS))),
    "dq_gold_key_uniqueness": _with(lambda m: checks.key_uniqueness_check(
        m.dim_customers, m.dim_products)),
    "dq_gold_null_keys": _with(lambda m: checks.null_key_check(
        m.dim_customers, m.dim_products)),
    "dq_gold_revenue_recon": _with(lambda m: checks.revenue_check(m.sales, m.fact)),
    "dq_gold_count_recon": _with(lambda m: checks.fact_count_check(m.sales, m.fact)),
    "dq_gold_null_fks": _with(lambda m: checks.null_foreign_key_check(m.fact)),
    "dq_gold_negative_sales": _with(lambda m: checks.negative_sales_check(m.fact)),
    "dq_gold_business_rules": _with(lambda m: checks.business_rules_check(m.fact)),
    "dq_gold_referential": dq_gold_referential,
    "dq_gold_orphans": dq_gold_orphans,
    "dq_gold_metric_consistency": _with(lambda m: checks.metric_consistency_check(
        m.fact_table("product_key", "sales_amount"), m.dim_products)),
    "dq_dim_completeness": dq_dim_completeness,
    "dq_score_bronze": _with(lambda m: _readable(_bronze_log(m))),
    "dq_score_silver": _with(lambda m: _readable(_silver_log(m))),
    "dq_score_gold": _with(lambda m: _readable(_gold_log(m))),
    "quality_log_roundtrip": quality_log_roundtrip,
    "quality_gate": _with(lambda m: quality_log.gate_verdict(_gold_log(m))),
    "quality_trend": quality_trend,
    "bronze_csv_roundtrip": bronze_csv_roundtrip,
    "bronze_rejects": bronze_rejects,
    "bronze_reject_files": bronze_reject_files,
    "distinct_over_loads": distinct_over_loads,
    "catalog_check": catalog_check,
    "counted_writes": counted_writes,
    "mart_revenue_by_country": _with(lambda m: marts.revenue_by_country(
        m.fact, m.dim_customers)),
    "mart_revenue_by_region": _with(lambda m: marts.revenue_by_region(m.fact, m.dim_customers)),
    "mart_customer_ltv": _with(lambda m: marts.customer_lifetime_value(
        m.fact, m.dim_customers)),
    "mart_top_products": _with(lambda m: marts.top_products(m.fact, m.dim_products)),
    "mart_top_products_by_category": _with(lambda m: marts.top_products_by_category(
        m.fact, m.dim_products)),
    "mart_segmentation": _with(lambda m: marts.customer_segments(m.fact, m.dim_customers)),
    "mart_kpi_trend": _with(lambda m: marts.kpi_trend(m.fact)),
    "stream_bronze_sales": stream_bronze_sales,
    "incremental_upsert": incremental_upsert,
    "incremental_gold": incremental_gold,
    "stable_surrogate_keys": stable_surrogate_keys,
}

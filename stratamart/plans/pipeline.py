"""The whole run, as plain calls in order: bronze, silver, gold, each followed by its checks."""

from __future__ import annotations

import datetime as dt

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from stratamart import fixed_values as V
from stratamart.operators import checks, gold, scoring
from stratamart.operators.quality_log import append_log, enforce_gate, log_row, verdict_rows
from stratamart.operators.silver import SILVER_BUILDERS, silver_demographics
from stratamart.schemas import LOG_SCHEMA
from stratamart.sources.csv_files import read_source
from stratamart.sources.tables import create_schemas, read_table, save_counted
from stratamart.staging import release


class Pipeline:
    """One configured run over a folder of source files.

    ``prefix`` goes before the schema names, ``fmt`` is the table format, ``blocking``
    says which layers' checks stop the run on a critical score.
    """

    def __init__(
        self,
        spark: SparkSession,
        source_root: str,
        *,
        prefix: str = "",
        location: str | None = None,
        fmt: str = "parquet",
        as_of: dt.date | None = None,
        blocking: frozenset[str] = frozenset({"GOLD"}),
        name: str = "stratamart",
    ) -> None:
        self.spark = spark
        self.source_root = source_root
        self.prefix = prefix
        self.location = location
        self.fmt = fmt
        self.as_of = as_of
        self.blocking = blocking
        self.name = name
        self.counts: dict[tuple[str, str], int] = {}  # rows of the tables this run wrote

    def table_name(self, layer: str, table: str) -> str:
        return f"`{self.prefix}{layer}`.`{table}`"

    def table(self, layer: str, table: str) -> DataFrame:
        return read_table(self.spark, self.table_name(layer, table))

    def _save(self, df: DataFrame, layer: str, table: str) -> None:
        self.counts[layer, table] = save_counted(df, self.table_name(layer, table), fmt=self.fmt)

    def setup(self) -> None:
        create_schemas(self.spark, prefix=self.prefix, location=self.location)

    def build_bronze(self) -> None:
        """Columns by header; what does not fit stays in ``_rejected``, files in ``_source_file``."""
        for table in V.SOURCE_FILES:
            self._save(
                read_source(self.spark, self.source_root, table, checked=True), "bronze", table)

    def build_silver(self) -> None:
        for source, build in SILVER_BUILDERS.items():
            bronze = self.table("bronze", source).drop("_rejected")
            made = (
                silver_demographics(bronze, self.as_of)
                if build is silver_demographics else build(bronze)
            )
            self._save(made, "silver", V.SILVER_TABLES[source])

    def build_dimensions(self) -> None:
        silver = {t: self.table("silver", t) for t in V.SILVER_TABLES.values()}
        self._save(
            gold.dim_customers(
                silver["crm_customers"], silver["erp_customers_id"],
                silver["erp_customer_location"],
            ),
            "gold", "dim_customers",
        )
        self._save(
            gold.dim_products(silver["crm_products"], silver["erp_product_category"]),
            "gold", "dim_products",
        )

    def build_fact(self) -> None:
        self._save(
            gold.fact_sales(
                self.table("silver", "crm_sales"),
                self.table("gold", "dim_products"), self.table("gold", "dim_customers"),
            ),
            "gold", "fact_sales",
        )

    def _record(self, score: DataFrame, task: str, layer: str) -> None:
        """Log one check run, then hold the gate. The one finished row passes the driver."""
        row = log_row(score, task, layer, pipeline=self.name).collect()
        logged = self.spark.createDataFrame(row, LOG_SCHEMA)
        append_log(logged, self.log_table, self.fmt)
        enforce_gate(logged, layer in self.blocking)

    @property
    def log_table(self) -> str:
        return self.table_name("monitoring", "data_quality_log")

    @property
    def checks_table(self) -> str:
        return self.table_name("monitoring", "quality_checks")

    def _verdicts(self, layer: str, *found: DataFrame) -> None:
        """Append the rows of a layer's checks, whatever their verdicts."""
        rows = [verdict_rows(f, layer, pipeline=self.name) for f in found]
        append_log(reduce(DataFrame.unionByName, rows), self.checks_table, self.fmt)

    def _silver_counts(self, source: str) -> DataFrame:
        """Rows of a source in bronze and silver: as counted when written, if this run wrote both."""
        tables = (("bronze", source), ("silver", V.SILVER_TABLES[source]))
        if all(t in self.counts for t in tables):
            return checks.known_counts(self.spark, *(self.counts[t] for t in tables))
        return checks.table_counts(*(self.table(*t) for t in tables))

    def check_bronze(self) -> None:
        crm = {t: self.table("bronze", t) for t in V.NULL_RULES_CRM}
        erp = {t: self.table("bronze", t) for t in V.NULL_RULES_ERP}
        self._verdicts(
            "BRONZE", checks.ingestion_check({**crm, **erp}), checks.duplicate_check({**crm, **erp}),
            checks.null_check_crm(crm), checks.null_check_erp(erp), checks.limit_check({**crm, **erp}),
            checks.reject_check({**crm, **erp}))
        self._record(scoring.bronze_crm_score(*crm.values()), V.TASK_BRONZE_CRM, "BRONZE")
        self._record(scoring.bronze_erp_score(*erp.values()), V.TASK_BRONZE_ERP, "BRONZE")

    def check_silver(self) -> None:
        silver = {t: self.table("silver", t) for t in V.SILVER_TABLES.values()}
        counts = {source: self._silver_counts(source) for source in V.SILVER_TASKS}
        self._verdicts(
            "SILVER", checks.reconciliation_of(counts),
            checks.silver_referential_check(
                silver["crm_sales"], silver["crm_products"], silver["crm_customers"]),
            checks.silver_rules_check(silver["crm_sales"]), checks.standardisation_check(silver),
            checks.silver_null_check(silver))
        for source, (task, _) in V.SILVER_TASKS.items():
            self._record(scoring.silver_score_of(counts[source], source), task, "SILVER")

    def check_dimensions(self) -> None:
        customers, products = self.table("gold", "dim_customers"), self.table("gold", "dim_products")
        self._verdicts(
            "GOLD", checks.key_uniqueness_check(customers, products),
            checks.null_key_check(customers, products))
        self._record(scoring.dimension_score(customers, products), V.TASK_GOLD_DIMENSIONS, "GOLD")

    def check_fact(self) -> None:
        sales, fact = self.table("silver", "crm_sales"), self.table("gold", "fact_sales")
        products, customers = self.table("gold", "dim_products"), self.table("gold", "dim_customers")
        self._verdicts(
            "GOLD", checks.revenue_check(sales, fact), checks.fact_count_check(sales, fact),
            checks.null_foreign_key_check(fact), checks.negative_sales_check(fact),
            checks.business_rules_check(fact), checks.referential_check(fact, products, customers))
        score = scoring.fact_score(sales, fact, products, customers)
        self._record(score, V.TASK_GOLD_FACT, "GOLD")

    def run(self) -> DataFrame:
        """Everything in order; returns the quality log."""
        self.setup()
        self.build_bronze()
        self.check_bronze()
        self.build_silver()
        self.check_silver()
        self.build_dimensions()
        release(self.spark)
        self.check_dimensions()
        self.build_fact()
        self.check_fact()
        return read_table(self.spark, self.log_table)

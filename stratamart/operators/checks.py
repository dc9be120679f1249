"""Data-quality checks. Each returns rows of check, metrics, status (and message).

A check reads each of its tables once: counts, nulls and rules of a table are one
aggregate. Where two tables are compared, both are reduced to one row first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart import fixed_values as V
from stratamart.functions import cleaning as C
from stratamart.functions.frames import fill, one_row, stack_rows, tiers, verdict

Tables = Mapping[str, DataFrame]


# --- bronze -------------------------------------------------------------------

def ingestion_verdict(counted: DataFrame, name: str) -> DataFrame:
    """The verdict on one row of record_count and unique_keys of a table."""
    rule, n = V.INGESTION_RULES[name], F.col("record_count")
    low = n < rule["expected_rows"]
    return counted.select(
        F.lit(V.CHECK_INGESTION).alias("check_name"),
        F.lit(name).alias("table_name"),
        "record_count",
        "unique_keys",
        tiers((n == 0, V.CRITICAL), (low, V.WARNING), otherwise=V.PASS).alias("status"),
        tiers(
            (n == 0, F.lit(rule["empty"])),
            (low, fill(rule["low"], n=n)),
            otherwise=fill(rule["good"], n=n),
        ).alias("message"),
    )


def ingestion_check(tables: Tables, approximate: bool = False) -> DataFrame:
    """Row count and distinct keys per table against the expected minimum.

    ``approximate`` trades exact distinct keys for a sketch without a shuffle of keys.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return stack_rows([
        ingestion_verdict(
            df.agg(
                F.count("*").alias("record_count"),
                distinct(F.col(V.INGESTION_RULES[name]["key"])).alias("unique_keys"),
            ), name)
        for name, df in tables.items()
    ])


def duplicate_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in, and number of, groups of more than one row; NULL keys form a group."""
    return (
        df.groupBy(*keys).count().where("count > 1")
        .agg(
            F.coalesce(F.sum("count"), F.lit(0)).alias("duplicate_records"),
            F.count("*").alias("duplicate_keys"),
        )
    )


def duplicate_check(tables: Tables) -> DataFrame:
    n = F.col("duplicate_keys")
    rows = []
    for name, df in tables.items():
        rule = V.DUPLICATE_RULES[name]
        minor, some = n < rule["pass_below"], n < rule["warning_below"]
        rows.append(
            duplicate_totals(df, rule["keys"]).select(
                F.lit(V.CHECK_DUPLICATES).alias("check_name"),
                F.lit(name).alias("table_name"),
                "duplicate_records",
                "duplicate_keys",
                tiers((minor, V.PASS), (some, V.WARNING), otherwise=V.CRITICAL).alias("status"),
                tiers(
                    (n == 0, F.lit(rule["none"])),
                    (minor, fill(rule["minor"], n=n)),
                    (some, fill(rule["some"], n=n)),
                    otherwise=fill(rule["many"], n=n),
                ).alias("message"),
            )
        )
    return stack_rows(rows)


def _null_counts(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    counted = [F.count_if(F.col(c).isNull()).alias(n) for c, n in zip(columns, names)]
    unused = [F.lit(0).cast("long").alias(n) for n in names[len(columns):]]
    return df.agg(F.count("*").alias("total_records"), *counted, *unused)


def _null_status(names: Sequence[str], used: int) -> Column:
    secondary = [F.col(c) > 0 for c in names[1:used]]
    steps = [(F.col(names[0]) > 0, V.CRITICAL)] + [(c, V.WARNING) for c in secondary]
    return tiers(*steps, otherwise=V.PASS)


def null_check_crm(tables: Tables) -> DataFrame:
    names, rows = V.NULL_COLUMNS_CRM, []
    for table, df in tables.items():
        columns = V.NULL_RULES_CRM[table]
        rows.append(_null_counts(df, columns, names).select(
            F.lit(V.CHECK_NULLS).alias("check_name"), F.lit(table).alias("table_name"),
            "total_records", *names, _null_status(names, len(columns)).alias("status"),
        ))
    return stack_rows(rows)


def null_check_erp(tables: Tables) -> DataFrame:
    names, rows = V.NULL_COLUMNS_ERP, []
    for table, df in tables.items():
        columns, labels = V.NULL_RULES_ERP[table], V.NULL_NAMES_ERP[table]
        texts = [V.NULL_CRITICAL_TEXT] + [V.NULL_WARNING_TEXT] * (len(columns) - 1)
        steps = [
            (F.col(n) > 0, fill(text + label, n=F.col(n)))
            for n, text, label in zip(names, texts, labels)
        ]
        rows.append(_null_counts(df, columns, names).select(
            F.lit(V.CHECK_NULLS).alias("check_name"), F.lit(table).alias("table_name"),
            "total_records", *names, _null_status(names, len(columns)).alias("status"),
            tiers(*steps, otherwise=V.NULL_GOOD_TEXT).alias("message"),
        ))
    return stack_rows(rows)


def reject_check(tables: Tables) -> DataFrame:
    """Rows and values that did not fit their columns, per table; a warning where there are any.

    A table without rows has none.
    """
    n = F.col("rejected_values")
    return stack_rows([
        df.agg(
            F.count("*").alias("total_records"),
            F.count("_rejected").alias("rejected_records"),
            F.coalesce(F.sum(F.size(F.map_keys("_rejected"))), F.lit(0)).cast("long").alias("rejected_values"),
        ).select(
            F.lit("Rejected Values").alias("check_name"), F.lit(name).alias("table_name"),
            "total_records", "rejected_records", "rejected_values",
            tiers((n > 0, V.WARNING), otherwise=V.PASS).alias("status"),
        )
        for name, df in tables.items()
    ])


def limit_check(tables: Tables) -> DataFrame:
    """The configured limits: fewest rows, share of duplicate rows, share of NULL keys."""
    rows = []
    for name, df in tables.items():
        keys = V.DUPLICATE_RULES[name]["keys"]
        no_key = F.lit(False)
        for k in keys:
            no_key = no_key | F.col(k).isNull()
        groups = df.groupBy(*keys).count()
        total = F.coalesce(F.sum("count"), F.lit(0))
        counted = groups.agg(
            total.alias("total_records"),
            F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("dup"),
            F.coalesce(F.sum(F.when(no_key, F.col("count"))), F.lit(0)).alias("nul"),
        )
        share = {
            c: F.coalesce(F.try_divide(F.col(c) * 100.0, F.col("total_records")), F.lit(0.0))
            for c in ("dup", "nul")
        }
        over = (share["dup"] > V.MAX_DUPLICATE_PCT) | (share["nul"] > V.MAX_NULL_PCT)
        rows.append(counted.select(
            F.lit("Configured Limits").alias("check_name"),
            F.lit(name).alias("table_name"),
            "total_records",
            share["dup"].alias("duplicate_pct"),
            share["nul"].alias("null_pct"),
            tiers(
                (F.col("total_records") < V.MIN_RECORD_COUNT, V.CRITICAL),
                (over, V.WARNING), otherwise=V.PASS,
            ).alias("status"),
        ))
    return stack_rows(rows)


# --- silver -------------------------------------------------------------------

def table_counts(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    return one_row(
        bronze.agg(F.count("*").alias("bronze_count")),
        silver.agg(F.count("*").alias("silver_count")),
    )


def known_counts(spark: SparkSession, bronze: int, silver: int) -> DataFrame:
    """Counts taken when the tables were written, as ``table_counts`` has them: nothing is read."""
    return spark.range(1).select(
        F.lit(bronze).cast("long").alias("bronze_count"), F.lit(silver).cast("long").alias("silver_count"))


def reconciliation_check(bronze: Tables, silver: Tables) -> DataFrame:
    """Bronze against silver row counts; customers have a middle tier."""
    return reconciliation_of({name: table_counts(bronze[name], silver[name]) for name in bronze})


def reconciliation_of(counts: Mapping[str, DataFrame]) -> DataFrame:
    """The same from one row of counts per source table."""
    diff = F.col("silver_count") - F.col("bronze_count")
    rows = []
    for name, counted in counts.items():
        near = F.abs(diff) < V.CUSTOMER_COUNT_WARNING_BELOW
        status = (
            tiers((diff == 0, V.PASS), (near, V.WARNING), otherwise=V.CRITICAL)
            if name == "crm_cust_info"
            else tiers((diff == 0, V.PASS), otherwise=V.WARNING)
        )
        rows.append(counted.select(
            F.lit(V.CHECK_RECONCILIATION).alias("check_name"),
            F.lit(V.SILVER_TABLES[name]).alias("table_name"),
            "bronze_count", "silver_count", diff.alias("diff"), status.alias("status"),
        ))
    return stack_rows(rows)


def missing_keys(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Non-NULL keys of ``df`` that ``other`` lacks, with their number of rows.

    Rows are counted per key first, so a hot key enters the join as one row.
    """
    keys = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).count()
    known = other.select(F.col(other_key).alias("_known"))
    return keys.join(known, keys["_key"] == known["_known"], "left_anti")


def missing_totals(
    df: DataFrame, key: str, other: DataFrame, other_key: str, keys_name: str, rows_name: str
) -> DataFrame:
    return missing_keys(df, key, other, other_key).agg(
        F.count("*").alias(keys_name),
        F.coalesce(F.sum("count"), F.lit(0)).alias(rows_name),
    )


def silver_referential_check(
    sales: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Sales whose product or customer is unknown to silver."""
    return one_row(
        missing_totals(sales, "product_number", products, "product_number",
                       "unknown_products", "product_rows"),
        missing_totals(sales, "customer_id", customers, "customer_id",
                       "unknown_customers", "customer_rows"),
    ).select(
        F.lit("Silver Referential Integrity").alias("check_name"),
        "unknown_products", "product_rows", "unknown_customers", "customer_rows",
        verdict(
            F.col("unknown_products") + F.col("unknown_customers") == 0, V.WARNING
        ).alias("status"),
    )


def silver_rules_check(sales: DataFrame) -> DataFrame:
    """Valid dates and positive amounts on silver sales, one pass."""
    ship, due, order = F.col("ship_date"), F.col("due_date"), F.col("order_date")
    return sales.agg(
        F.count("*").alias("total_records"),
        F.count_if(order.isNull()).alias("missing_order_dates"),
        F.count_if(ship < order).alias("invalid_ship_dates"),
        F.count_if(due < order).alias("invalid_due_dates"),
        F.count_if(F.col("sales_amount") < 0).alias("negative_sales"),
        F.count_if(F.col("quantity") <= 0).alias("non_positive_quantities"),
    ).select(
        F.lit("Silver Business Rules").alias("check_name"),
        "*",
        tiers(
            (F.col("total_records") == 0, V.CRITICAL),
            (F.col("negative_sales") > 0, V.CRITICAL),
            (F.col("invalid_ship_dates") + F.col("invalid_due_dates") > 0, V.WARNING),
            otherwise=V.PASS,
        ).alias("status"),
    )


def _per_column(df: DataFrame, table: str, measures: Mapping[str, Column]) -> DataFrame:
    """One aggregate over the table, then one row per measured column."""
    wide = df.agg(
        F.count("*").alias("_n"),
        *[m.alias(f"_m{i}") for i, m in enumerate(measures.values())],
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("violations"))
        for i, c in enumerate(measures)
    ]
    return wide.select(
        F.lit(table).alias("table_name"), F.col("_n").alias("total_records"),
        F.inline(F.array(*entries)),
    )


# Values each standardised silver column may hold.
ALLOWED_LABELS = {
    "crm_customers": {
        "marital_status": [*V.MARITAL_STATUS.values(), V.UNKNOWN],
        "gender": [*V.GENDER_CODES.values(), V.UNKNOWN],
    },
    "crm_products": {"product_line": [*V.PRODUCT_LINES.values(), V.UNKNOWN]},
    "erp_customers_id": {"gender": [*V.GENDER_CODES.values(), V.UNKNOWN]},
}


def standardisation_check(silver: Tables) -> DataFrame:
    """Values outside the allowed labels, per standardised column."""
    rows = []
    for table, columns in ALLOWED_LABELS.items():
        measures = {
            c: F.count_if(~F.coalesce(F.col(c).isin(labels), F.lit(False)))
            for c, labels in columns.items()
        }
        rows.append(_per_column(silver[table], table, measures))
    country = F.col("country")
    raw_code = country.isNull() | country.isin("", *V.COUNTRIES)
    rows.append(_per_column(
        silver["erp_customer_location"], "erp_customer_location", {"country": F.count_if(raw_code)}
    ))
    return stack_rows(rows).select(
        F.lit("Standardisation").alias("check_name"), "*",
        verdict(F.col("violations") == 0, V.WARNING).alias("status"),
    )


# Join keys of each silver table: the first is critical, the others secondary.
SILVER_KEYS = {
    "crm_customers": ["customer_id", "customer_key"],
    "crm_products": ["product_id", "product_number", "category_id"],
    "crm_sales": ["order_number", "product_number", "customer_id"],
    "erp_customers_id": ["customer_number"],
    "erp_customer_location": ["customer_number"],
    "erp_product_category": ["category_id"],
}


def silver_null_check(silver: Tables) -> DataFrame:
    """NULL join keys per silver column."""
    rows = []
    for table, columns in SILVER_KEYS.items():
        found = _per_column(
            silver[table], table, {c: F.count_if(F.col(c).isNull()) for c in columns}
        )
        first = F.col("column_name") == columns[0]
        rows.append(found.select(
            F.lit("Silver Null Keys").alias("check_name"), "*",
            tiers(
                (F.col("violations") == 0, V.PASS), (first, V.CRITICAL), otherwise=V.WARNING
            ).alias("status"),
        ))
    return stack_rows(rows)


# How each raw column has to read: a value that is there but does not read is counted.
# "code" is a date code, "flag" a yes/no flag, the rest are Spark types.
TYPE_RULES = {
    "crm_cust_info": {
        "cst_id": "bigint",
        "cst_create_date": "date",
    },
    "crm_prd_info": {
        "prd_id": "bigint",
        "prd_cost": "int",
        "prd_start_dt": "date",
        "prd_end_dt": "date",
    },
    "crm_sales_details": {
        "sls_cust_id": "bigint",
        "sls_order_dt": "code",
        "sls_ship_dt": "code",
        "sls_due_dt": "code",
        "sls_sales": "int",
        "sls_quantity": "int",
        "sls_price": "int",
    },
    "erp_cust_az12": {"BDATE": "date"},
    "erp_px_cat_g1v2": {"MAINTENANCE": "flag"},
}


def _read_as(col: str, kind: str) -> Column:
    if kind == "code":
        return C.date_code(col)
    if kind == "flag":
        return C.yes_no(f"trim({col})")
    return F.expr(f"try_cast({col} AS {kind})")


def type_check(tables: Tables) -> DataFrame:
    """Values present that do not convert to the column's silver type."""
    rows = []
    for table, rules in TYPE_RULES.items():
        measures = {
            c: F.count_if(F.col(c).isNotNull() & _read_as(c, kind).isNull())
            for c, kind in rules.items()
        }
        rows.append(_per_column(tables[table], table, measures))
    return stack_rows(rows).select(
        F.lit("Data Types").alias("check_name"), "*",
        verdict(F.col("violations") == 0, V.WARNING).alias("status"),
    )


# --- gold: dimensions ---------------------------------------------------------

def key_uniqueness_check(customers: DataFrame, products: DataFrame) -> DataFrame:
    totals = one_row(
        duplicate_totals(customers, ["customer_key"])
        .select(F.col("duplicate_records").alias("customer_duplicates")),
        duplicate_totals(products, ["product_key"])
        .select(F.col("duplicate_records").alias("product_duplicates")),
    )
    return totals.select(
        F.lit(V.CHECK_UNIQUENESS).alias("check_name"), "*",
        verdict(F.col("customer_duplicates") + F.col("product_duplicates") == 0).alias("status"),
    )


def null_key_check(customers: DataFrame, products: DataFrame) -> DataFrame:
    totals = one_row(
        customers.agg(F.count_if(F.col("customer_key").isNull()).alias("null_customer_keys")),
        products.agg(F.count_if(F.col("product_key").isNull()).alias("null_product_keys")),
    )
    return totals.select(
        F.lit(V.CHECK_NULL_KEYS).alias("check_name"), "*",
        verdict(F.col("null_customer_keys") + F.col("null_product_keys") == 0).alias("status"),
    )


def dimension_completeness_check(
    silver: DataFrame, dimension: DataFrame, key: str, name: str
) -> DataFrame:
    """Natural keys of silver that did not reach the dimension."""
    return one_row(
        silver.agg(
            F.count("*").alias("silver_rows"),
            F.count_if(F.col(key).isNull()).alias("silver_null_keys"),
        ),
        missing_totals(silver, key, dimension, key, "missing_keys", "missing_rows"),
    ).select(
        F.lit("Dimension Completeness").alias("check_name"),
        F.lit(name).alias("table_name"),
        "silver_rows", "silver_null_keys", "missing_keys", "missing_rows",
        verdict(F.col("missing_keys") == 0).alias("status"),
    )


# --- gold: fact ---------------------------------------------------------------

def fact_measures(fact: DataFrame, *by: Column) -> DataFrame:
    """All row counts the fact checks and its score need, in one pass."""
    ship, due, order = F.col("ship_date"), F.col("due_date"), F.col("order_date")
    no_product, no_customer = F.col("product_key").isNull(), F.col("customer_key").isNull()
    gap = F.abs(F.col("sales_amount") - F.col("price") * F.col("quantity"))
    return fact.groupBy(*by).agg(
        F.count("*").alias("gold_count"),
        F.sum("sales_amount").alias("gold_revenue"),
        F.count_if(no_product).alias("null_product_keys"),
        F.count_if(no_customer).alias("null_customer_keys"),
        F.count_if(no_product | no_customer).alias("null_keys"),
        F.count_if(F.col("sales_amount") < 0).alias("negative_sales"),
        F.count_if(ship < order).alias("invalid_ship_dates"),
        F.count_if(due < order).alias("invalid_due_dates"),
        F.count_if((ship < order) | (due < order)).alias("invalid_dates"),
        F.count_if(gap > V.PRICE_TOLERANCE).alias("price_calc_errors"),
    )


def sales_measures(sales: DataFrame, *by: Column) -> DataFrame:
    return sales.groupBy(*by).agg(
        F.count("*").alias("silver_count"), F.sum("sales_amount").alias("silver_revenue")
    )


def revenue_check(sales: DataFrame, fact: DataFrame) -> DataFrame:
    silver, gold = F.col("silver_revenue"), F.col("gold_revenue")
    pct = F.abs((gold - silver) / F.nullif(silver, F.lit(0))) * 100
    return one_row(sales_measures(sales), fact_measures(fact)).select(
        F.lit(V.CHECK_REVENUE).alias("check_name"),
        "silver_revenue", "gold_revenue",
        (gold - silver).alias("diff"), pct.alias("diff_pct"),
        verdict(pct < V.REVENUE_TOLERANCE_PCT).alias("status"),
    )


def fact_count_check(sales: DataFrame, fact: DataFrame) -> DataFrame:
    diff = F.col("gold_count") - F.col("silver_count")
    return one_row(sales_measures(sales), fact_measures(fact)).select(
        F.lit(V.CHECK_COUNT).alias("check_name"),
        "silver_count", "gold_count", diff.alias("diff"), verdict(diff == 0).alias("status"),
    )


def null_foreign_key_check(fact: DataFrame) -> DataFrame:
    n = F.col("gold_count")
    return fact_measures(fact).select(
        F.lit(V.CHECK_NULL_FKS).alias("check_name"), n.alias("total_records"),
        "null_product_keys", "null_customer_keys",
        verdict((n > 0) & (F.col("null_keys") == 0)).alias("status"),
    )


def negative_sales_check(fact: DataFrame) -> DataFrame:
    n, bad = F.col("gold_count"), F.col("negative_sales")
    return fact_measures(fact).select(
        F.lit(V.CHECK_NEGATIVE).alias("check_name"), n.alias("total_records"),
        bad.alias("negative_count"),
        verdict((n > 0) & (bad <= V.MAX_NEGATIVE_SALES)).alias("status"),
    )


def business_rules_check(fact: DataFrame) -> DataFrame:
    """Date order decides the status; price arithmetic is counted only."""
    good = (F.col("gold_count") > 0) & (F.col("invalid_dates") == 0)
    return fact_measures(fact).select(
        F.lit(V.CHECK_RULES).alias("check_name"),
        "invalid_ship_dates", "invalid_due_dates", "price_calc_errors",
        verdict(good, V.WARNING).alias("status"),
    )


def orphan_counts(fact: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct non-NULL fact keys no dimension row has; one pass for both keys.

    Keys are made distinct before the join, so a hot key enters it as one row.
    """
    def keyed(side: str, key: str) -> Column:
        return F.struct(F.lit(side).alias("side"), F.col(key).cast("long").alias("key"))

    used = fact.select(
        F.inline(F.array(keyed("product", "product_key"), keyed("customer", "customer_key")))
    ).where(F.col("key").isNotNull()).distinct()
    known = products.select(keyed("product", "product_key").alias("k")).unionByName(
        customers.select(keyed("customer", "customer_key").alias("k"))
    ).select("k.*")
    orphans = used.join(known, ["side", "key"], "left_anti")
    return orphans.agg(
        F.count_if(F.col("side") == "product").alias("orphaned_products"),
        F.count_if(F.col("side") == "customer").alias("orphaned_customers"),
    )


def key_measures(fact: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows without a product or customer key, and ``orphan_counts``, from counts per key.

    Each key is counted on its own: over a fact that is only planned, Spark then plans no
    more than the lookup the key comes from, and moves no other column.
    """
    def counted(side: str, key: str) -> DataFrame:
        return fact.groupBy(F.col(key).cast("long").alias("key")).agg(
            F.count("*").alias("rows")).withColumn("side", F.lit(side))

    used = counted("product", "product_key").unionByName(counted("customer", "customer_key"))
    known = products.select(
        F.lit("product").alias("_side"), F.col("product_key").cast("long").alias("_key")
    ).unionByName(customers.select(F.lit("customer"), F.col("customer_key").cast("long")).toDF("_side", "_key"))
    match = (F.col("side") == F.col("_side")) & (F.col("key") == F.col("_key"))
    product, missing = F.col("side") == "product", F.col("key").isNull()
    orphan = ~missing & F.col("_key").isNull()

    def rows_without(side: Column) -> Column:
        return F.coalesce(F.sum(F.when(side & missing, F.col("rows"))), F.lit(0))

    # A key that a dimension holds twice joins twice, but only what joins nothing is counted.
    return used.join(known, match, "left").agg(
        rows_without(product).alias("null_product_keys"),
        rows_without(~product).alias("null_customer_keys"),
        F.count_if(product & orphan).alias("orphaned_products"),
        F.count_if(~product & orphan).alias("orphaned_customers"),
    )


def referential_check(fact: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    total = F.col("orphaned_products") + F.col("orphaned_customers")
    return orphan_counts(fact, products, customers).select(
        F.lit(V.CHECK_REFERENTIAL).alias("check_name"), "*",
        verdict(total <= V.MAX_ORPHANED_KEYS).alias("status"),
    )


def metric_consistency_check(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue summed by category against the fact's own total."""
    per_category = revenue_by_category(fact, products)
    return one_row(
        per_category.agg(
            F.sum("revenue").alias("category_revenue"), F.count("*").alias("categories")
        ),
        fact.agg(F.sum("sales_amount").alias("fact_revenue")),
    ).select(
        F.lit("Metric Consistency").alias("check_name"),
        "categories", "category_revenue", "fact_revenue",
        verdict(F.col("category_revenue") == F.col("fact_revenue")).alias("status"),
    )


def revenue_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per category; summed per product before the join."""
    per_product = fact.groupBy("product_key").agg(F.sum("sales_amount").alias("revenue"))
    names = products.select(F.col("product_key").alias("_key"), "category")
    return (
        per_product.join(names, F.col("product_key") == F.col("_key"), "left")
        .groupBy(F.coalesce("category", F.lit(V.UNKNOWN)).alias("category"))
        .agg(F.sum("revenue").alias("revenue"))
    )

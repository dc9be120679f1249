"""Values that have to be exactly these for results to be right.

Code tables, column names, thresholds, status labels and message texts are part
of the data contract of the layered sales model: dashboards and log readers
compare against them literally. They are stated here as plain text and used
from here by every operator.
"""

from __future__ import annotations

# --- fixed values: status labels and the scores that separate them -----------
PASS = "✅ PASS"
WARNING = "🟡 WARNING"
CRITICAL = "🔴 CRITICAL"

CRITICAL_BELOW_SCORE = 70
PASS_SCORE = 100

# --- fixed values: label used where a code is unknown or missing ------------
UNKNOWN = "n/a"

# --- fixed values: code tables ------------------------------------------------
MARITAL_STATUS = {"S": "Single", "M": "Married"}
GENDER_CODES = {"M": "Male", "F": "Female"}
GENDER_SYNONYMS = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINES = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRIES = {"DE": "Germany", "US": "United States", "USA": "United States"}
YES_NO = {"YES": True, "NO": False}

# --- fixed values: key formats ------------------------------------------------
ERP_CUSTOMER_PREFIX = "NAS"
CATEGORY_ID_LENGTH = 5
PRODUCT_NUMBER_START = 7
DATE_CODE_RANGE = (10000000, 99999999)  # yyyyMMdd: eight digits

# --- fixed values: silver column names ---------------------------------------
RENAME_CUSTOMERS = {
    "cst_id": "customer_id",
    "cst_key": "customer_key",
    "cst_firstname": "firstname",
    "cst_lastname": "lastname",
    "cst_marital_status": "marital_status",
    "cst_gndr": "gender",
    "cst_create_date": "created_date",
}
RENAME_PRODUCTS = {
    "prd_id": "product_id",
    "cat_id": "category_id",
    "prd_key": "product_number",
    "prd_nm": "product_name",
    "prd_cost": "product_cost",
    "prd_line": "product_line",
    "prd_start_dt": "start_date",
    "prd_end_dt": "end_date",
}
RENAME_SALES = {
    "sls_ord_num": "order_number",
    "sls_prd_key": "product_number",
    "sls_cust_id": "customer_id",
    "sls_order_dt": "order_date",
    "sls_ship_dt": "ship_date",
    "sls_due_dt": "due_date",
    "sls_sales": "sales_amount",
    "sls_quantity": "quantity",
    "sls_price": "price",
}
RENAME_DEMOGRAPHICS = {"cid": "customer_number", "bdate": "birth_date", "gen": "gender"}
RENAME_LOCATION = {"cid": "customer_number", "cntry": "country"}
RENAME_CATEGORY = {
    "id": "category_id",
    "cat": "category",
    "subcat": "subcategory",
    "maintenance": "maintenance_flag",
}

# --- fixed values: schemas of the model and their comments --------------------
LAYER_SCHEMAS = {
    "bronze": "Bronze layer: raw ingested data",
    "silver": "Silver layer: cleaned and transformed data",
    "gold": "Gold layer: business-ready data",
    "monitoring": "Monitoring: data quality logs and metrics",
}

# --- fixed values: source files of the bronze tables --------------------------
SOURCE_FILES = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_cust_az12": "source_erp/CUST_AZ12.csv",
    "erp_loc_a101": "source_erp/LOC_A101.csv",
    "erp_px_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
}

# --- fixed values: silver table made from each bronze table -------------------
SILVER_TABLES = {
    "crm_cust_info": "crm_customers",
    "crm_prd_info": "crm_products",
    "crm_sales_details": "crm_sales",
    "erp_cust_az12": "erp_customers_id",
    "erp_loc_a101": "erp_customer_location",
    "erp_px_cat_g1v2": "erp_product_category",
}

# --- fixed values: ingestion check (minimum rows and messages) ----------------
INGESTION_RULES = {
    "crm_cust_info": {
        "key": "cst_id",
        "expected_rows": 1000,
        "empty": "CRITICAL: No records ingested from cust_info.csv",
        "low": "WARNING: Only {n} customers ingested - expected more",
        "good": "PASS: {n} customer records ingested successfully",
    },
    "crm_prd_info": {
        "key": "prd_id",
        "expected_rows": 100,
        "empty": "CRITICAL: No records ingested from prd_info.csv",
        "low": "WARNING: Only {n} products ingested - expected more",
        "good": "PASS: {n} product records ingested successfully",
    },
    "crm_sales_details": {
        "key": "sls_ord_num",
        "expected_rows": 1000,
        "empty": "CRITICAL: No records ingested from sales_details.csv",
        "low": "WARNING: Only {n} sales records ingested - expected more",
        "good": "PASS: {n} sales records ingested successfully",
    },
    "erp_cust_az12": {
        "key": "CID",
        "expected_rows": 100,
        "empty": "CRITICAL: No records ingested from CUST_AZ12.csv",
        "low": "WARNING: Only {n} customer IDs ingested - expected more",
        "good": "PASS: {n} customer ID records ingested successfully",
    },
    "erp_loc_a101": {
        "key": "CID",
        "expected_rows": 100,
        "empty": "CRITICAL: No records ingested from LOC_A101.csv",
        "low": "WARNING: Only {n} location records ingested - expected more",
        "good": "PASS: {n} location records ingested successfully",
    },
    "erp_px_cat_g1v2": {
        "key": "ID",
        "expected_rows": 50,
        "empty": "CRITICAL: No records ingested from PX_CAT_G1V2.csv",
        "low": "WARNING: Only {n} product categories ingested - expected more",
        "good": "PASS: {n} product category records ingested successfully",
    },
}

# --- fixed values: duplicate check (natural keys, tiers and messages) ---------
DUPLICATE_RULES = {
    "crm_cust_info": {
        "keys": ["cst_id"],
        "pass_below": 50,
        "warning_below": 100,
        "none": "PASS: No duplicate customer IDs found",
        "minor": "PASS: Only {n} minor customer ID duplicates (acceptable)",
        "some": "WARNING: {n} duplicate customer IDs found",
        "many": "CRITICAL: {n} duplicate customer IDs found - investigate source data",
    },
    "crm_prd_info": {
        "keys": ["prd_id"],
        "pass_below": 20,
        "warning_below": 50,
        "none": "PASS: No duplicate product IDs found",
        "minor": "PASS: Only {n} minor product ID duplicates (acceptable)",
        "some": "WARNING: {n} duplicate product IDs found",
        "many": "CRITICAL: {n} duplicate product IDs found - investigate source data",
    },
    "crm_sales_details": {
        "keys": ["sls_ord_num", "sls_prd_key"],
        "pass_below": 1,
        "warning_below": 10,
        "none": "PASS: No duplicate order numbers found",
        "minor": "PASS: No duplicate order numbers found",
        "some": "WARNING: {n} duplicate order numbers found",
        "many": "CRITICAL: {n} duplicate order numbers found - investigate source data",
    },
    "erp_cust_az12": {
        "keys": ["CID"],
        "pass_below": 20,
        "warning_below": 50,
        "none": "PASS: No duplicate customer IDs found",
        "minor": "PASS: Only {n} minor customer ID duplicates (acceptable)",
        "some": "WARNING: {n} duplicate customer IDs found",
        "many": "CRITICAL: {n} duplicate customer IDs found - investigate source data",
    },
    "erp_loc_a101": {
        "keys": ["CID"],
        "pass_below": 20,
        "warning_below": 50,
        "none": "PASS: No duplicate location records found",
        "minor": "PASS: Only {n} minor location duplicates (acceptable)",
        "some": "WARNING: {n} duplicate location records found",
        "many": "CRITICAL: {n} duplicate location records found - investigate source data",
    },
    "erp_px_cat_g1v2": {
        "keys": ["ID"],
        "pass_below": 10,
        "warning_below": 25,
        "none": "PASS: No duplicate product category IDs found",
        "minor": "PASS: Only {n} minor category duplicates (acceptable)",
        "some": "WARNING: {n} duplicate category IDs found",
        "many": "CRITICAL: {n} duplicate category IDs found - investigate source data",
    },
}

# --- fixed values: null check (first column is critical, others secondary) ----
NULL_RULES_CRM = {
    "crm_cust_info": ["cst_id", "cst_key", "cst_firstname"],
    "crm_prd_info": ["prd_id", "prd_key"],
    "crm_sales_details": ["sls_ord_num", "sls_prd_key", "sls_cust_id"],
}
NULL_RULES_ERP = {
    "erp_cust_az12": ["CID"],
    "erp_loc_a101": ["CID", "CNTRY"],
    "erp_px_cat_g1v2": ["ID", "CAT"],
}
NULL_COLUMNS_CRM = ["null_cst_id", "null_cst_key", "null_firstname"]
NULL_COLUMNS_ERP = ["null_cid", "null_field2", "null_field3"]
NULL_NAMES_ERP = {
    "erp_cust_az12": ["customer ID"],
    "erp_loc_a101": ["customer ID", "country"],
    "erp_px_cat_g1v2": ["product ID", "category"],
}
NULL_CRITICAL_TEXT = "CRITICAL: {n} records with NULL "
NULL_WARNING_TEXT = "WARNING: {n} records with NULL "
NULL_GOOD_TEXT = "PASS: No NULL values in critical fields"

# --- fixed values: silver reconciliation --------------------------------------
CUSTOMER_COUNT_WARNING_BELOW = 10
SILVER_MISMATCH_SCORE = 85

# --- fixed values: gold fact tolerances ---------------------------------------
REVENUE_TOLERANCE_PCT = 0.01
PRICE_TOLERANCE = 0.01

# --- fixed values: configured bronze and gold limits --------------------------
MIN_RECORD_COUNT = 1
MAX_DUPLICATE_PCT = 10.0
MAX_NULL_PCT = 10.0
MAX_NEGATIVE_SALES = 0
MAX_ORPHANED_KEYS = 0

# --- fixed values: check names ------------------------------------------------
CHECK_INGESTION = "File Ingestion Validation"
CHECK_DUPLICATES = "Duplicate Detection"
CHECK_NULLS = "Null Critical Fields"
CHECK_RECONCILIATION = "Bronze-Silver Reconciliation"
CHECK_UNIQUENESS = "Dimension Uniqueness"
CHECK_NULL_KEYS = "Null Primary Keys"
CHECK_REVENUE = "Revenue Reconciliation"
CHECK_COUNT = "Record Count"
CHECK_NULL_FKS = "Null Foreign Keys"
CHECK_NEGATIVE = "Negative Sales"
CHECK_RULES = "Business Rules"
CHECK_REFERENTIAL = "Referential Integrity"

# --- fixed values: bronze scores and issue texts ------------------------------
# (counter, score when that counter is the first to be zero, issue text)
BRONZE_CRM_EMPTY = [
    ("customers", 20, "No customer records ingested"),
    ("products", 30, "No product records ingested"),
    ("sales", 40, "No sales records ingested"),
]
BRONZE_ERP_EMPTY = [
    ("cust_ids", 20, "No customer ID records ingested"),
    ("locations", 30, "No location records ingested"),
    ("categories", 40, "No product category records ingested"),
]
BRONZE_CRM_ALL_EMPTY = "No records ingested from any CRM source file"
BRONZE_ERP_ALL_EMPTY = "No records ingested from any ERP source file"
# (counter, penalised below, points, warning text)
BRONZE_CRM_LOW = [
    ("customers", 1000, 5, "Low customer count: {n}"),
    ("products", 100, 5, "Low product count: {n}"),
    ("sales", 1000, 10, "Low sales count: {n}"),
]
BRONZE_ERP_LOW = [
    ("cust_ids", 50, 10, "Low customer ID count: {n}"),
    ("categories", 10, 10, "Low category count: {n}"),
]
BRONZE_CRM_SUMMARY = (
    "Bronze CRM Quality: {total} total records "
    "({customers} customers, {products} products, {sales} sales)"
)
BRONZE_ERP_SUMMARY = (
    "Bronze ERP Quality: {total} total records "
    "({cust_ids} customer IDs, {locations} locations, {categories} categories)"
)

# --- fixed values: gold scores and issue texts --------------------------------
DIM_EMPTY = {
    "customers": "No customer dimension records",
    "products": "No product dimension records",
}
# (counter, penalised below, points, warning text)
DIM_LOW = [
    ("customers", 100, 10, "Low customer count: {n}"),
    ("products", 50, 10, "Low product count: {n}"),
]
DIM_SUMMARY = "Gold Dimensions: {customers} customers, {products} products"
FACT_COUNT_POINTS = 30
FACT_REVENUE_POINTS = 40
FACT_ROW_POINTS = 10
FACT_COUNT_ISSUE = "Record count mismatch: Gold {gold} != Silver {silver}"
FACT_REVENUE_ISSUE = "Revenue mismatch: {pct}% difference"
FACT_NULL_PRODUCT_ISSUE = "{n} records with null product_key"
FACT_NULL_CUSTOMER_ISSUE = "{n} records with null customer_key"
FACT_NEGATIVE_ISSUE = "{n} records with negative sales_amount"
FACT_SUMMARY = "Gold Fact Sales: {n} records, ${revenue} revenue"

# --- fixed values: log task names and silver summaries ------------------------
TASK_BRONZE_CRM = "Quality_Bronze_CRM"
TASK_BRONZE_ERP = "Quality_Bronze_ERP"
TASK_GOLD_DIMENSIONS = "Quality_Gold_Dimensions"
TASK_GOLD_FACT = "Quality_Gold_Fact_Sales"
SILVER_TASKS = {
    "crm_cust_info": (
        "Quality_Silver_CRM_Customers",
        "Silver CRM Customers: {silver} from {bronze} Bronze",
    ),
    "crm_prd_info": (
        "Quality_Silver_CRM_Products",
        "Silver CRM Products: {silver} from {bronze}",
    ),
    "crm_sales_details": (
        "Quality_Silver_CRM_Sales",
        "Silver CRM Sales: {silver} from {bronze}",
    ),
    "erp_cust_az12": (
        "Quality_Silver_ERP_Customers",
        "Silver ERP Customers: {silver} from {bronze}",
    ),
    "erp_loc_a101": (
        "Quality_Silver_ERP_Location",
        "Silver ERP Location: {silver} from {bronze}",
    ),
    "erp_px_cat_g1v2": (
        "Quality_Silver_ERP_Products",
        "Silver ERP Products: {silver} from {bronze}",
    ),
}

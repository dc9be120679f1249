import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratamart import fixed_values as V
from stratamart.operators import checks
from stratamart.operators.quality_log import QualityGateError
from stratamart.plans.pipeline import Pipeline
from stratamart.schemas import BRONZE_SCHEMAS
from stratamart.sources import csv_files, tables
from stratamart.staging import new_path, release, shared_folder, stage

CATEGORIES = "ID,CAT,SUBCAT,MAINTENANCE\r\nAC_HE,Accessories,Helmets,Yes\r\n"
PRODUCTS = ("prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\r\n"
            "1,AC-HE-P1,Helmet,,S ,2011-07-01,2007-12-28\r\n"
            "2,AC-HE-P1,Helmet,13,S ,2013-07-01,\r\n")
CUSTOMERS = ("cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,"
             "cst_create_date\r\n11,AW1, Ann ,A,M,,2020-01-01\r\n,AW2,Bob,B,S,M,\r\n")
SALES = ("sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,"
         "sls_quantity,sls_price\r\nSO1,P1,11,20200105,20200106,20200107,30,2,15\r\n"
         "SO2,P1,11,0,20200106,20200107,-4,1,4\r\n")
PEOPLE = "CID,BDATE,GEN\r\nNASAW1,1980-01-01,Female\r\n"
PLACES = "CID,CNTRY\r\nAW-1,US\r\n"


@pytest.fixture()
def source(tmp_path):
    texts = {"crm_cust_info": CUSTOMERS, "crm_prd_info": PRODUCTS, "crm_sales_details": SALES,
             "erp_cust_az12": PEOPLE, "erp_loc_a101": PLACES, "erp_px_cat_g1v2": CATEGORIES}
    for table, text in texts.items():
        path = tmp_path / V.SOURCE_FILES[table]
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(text.encode())
    return str(tmp_path)


def test_csv_read_with_schema_strips_line_ends_and_keeps_blanks_null(spark, source):
    df = csv_files.read_source(spark, source, "erp_px_cat_g1v2", lineage=False)
    assert rows(df) == [("AC_HE", "Accessories", "Helmets", "Yes")]
    cust = csv_files.read_source(spark, source, "crm_cust_info")
    assert cust.schema["cst_id"].dataType == BRONZE_SCHEMAS["crm_cust_info"]["cst_id"].dataType
    assert cust.where("cst_key = 'AW2'").first().cst_id is None
    assert cust.first().cst_firstname == " Ann "
    assert cust.first()["_source_table"] == "crm_cust_info"
    assert cust.first()["_ingest_ts"] is not None


def test_csv_inference_and_text_reading(spark, source):
    inferred = csv_files.read_source(spark, source, "crm_sales_details", infer=True, lineage=False)
    assert dict(inferred.dtypes)["sls_order_dt"] == "int"
    text = csv_files.read_source(spark, source, "crm_prd_info", text=True, lineage=False)
    assert set(dict(text.dtypes).values()) == {"string"}


def test_checked_reading_goes_by_header_and_keeps_what_does_not_fit(spark, tmp_path):
    path = tmp_path / V.SOURCE_FILES["crm_sales_details"]
    path.parent.mkdir()
    path.write_text(
        "sls_price,sls_ord_num,extra,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,"
        "sls_sales,sls_quantity\n"
        "25.50,SO1,x,P1,11,20200105,20200106,20200107,3000000000,abc\n"
        " 15 ,SO2,x,P1,11,20200105,20200106,20200107,30,2.0\n")
    narrow = csv_files.read_source(
        spark, str(tmp_path), "crm_sales_details", checked=True,
        schema=BRONZE_SCHEMAS["crm_sales_details"])
    bad, good = narrow.orderBy("sls_ord_num").collect()
    assert bad._rejected == {"sls_price": "25.50", "sls_sales": "3000000000", "sls_quantity": "abc"}
    assert bad.sls_price is None and bad.sls_cust_id == 11
    assert good._rejected is None and (good.sls_price, good.sls_quantity) == (15, 2)
    assert rows(csv_files.rejects(narrow, "sales"), "column_name", "rejected") == [
        ("sls_price", 1), ("sls_quantity", 1), ("sls_sales", 1)]
    wide = csv_files.read_source(spark, str(tmp_path), "crm_sales_details", checked=True)
    bad, good = wide.orderBy("sls_ord_num").collect()
    assert bad._rejected == {"sls_quantity": "abc"}  # money keeps its fraction and its size
    assert (bad.sls_price, bad.sls_sales) == (Decimal("25.50"), 3_000_000_000)
    assert good._rejected is None and (good.sls_price, good.sls_quantity) == (15, 2)


def test_rejects_are_traced_to_their_file(spark, tmp_path):
    folder = tmp_path / V.SOURCE_FILES["crm_sales_details"]
    folder.mkdir(parents=True)
    head = SALES.split("\r\n")[0]
    (folder / "a.csv").write_text(f"{head}\nSO1,P1,11,20200105,20200106,20200107,1.23456,2,15\n")
    (folder / "b.csv").write_text(f"{head}\nSO2,P1,11,20200105,20200106,x,1.2345,2,y\nSO3,,,,,,,,\n")
    df = csv_files.read_source(spark, str(tmp_path), "crm_sales_details", checked=True)
    found = rows(csv_files.rejects_by_file(df, "s"), F.regexp_extract("source_file", "[^/]*$", 0),
                 "column_name", "rejected")
    assert found == [("a.csv", "sls_sales", 1), ("b.csv", "sls_due_dt", 1), ("b.csv", "sls_price", 1)]
    assert df.where("_source_modified IS NULL OR _source_block <> 0").count() == 0
    got = checks.reject_check({"crm_sales_details": df}).first()
    assert (got.total_records, got.rejected_records, got.rejected_values, got.status) == (3, 2, 3, V.WARNING)
    none = checks.reject_check({"crm_sales_details": df.limit(0)}).first()
    assert (none.total_records, none.rejected_values, none.status) == (0, 0, V.PASS)


def test_a_file_with_another_column_order_is_not_read_by_position(spark, tmp_path):
    folder = tmp_path / V.SOURCE_FILES["erp_loc_a101"]
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("CID,CNTRY\nAW1,US\n")
    (folder / "b.csv").write_text("CNTRY,CID\nDE,AW2\n")
    with pytest.raises(Exception, match="CSV header"):
        csv_files.read_source(spark, str(tmp_path), "erp_loc_a101", checked=True).collect()


def test_the_run_reads_by_header_and_keeps_fractions(spark, source, tmp_path):
    path = tmp_path / V.SOURCE_FILES["crm_sales_details"]
    path.write_text(
        "sls_price,sls_sales,sls_quantity,sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,"
        "sls_ship_dt,sls_due_dt\n"
        "25.50,7650000000051,300000000002,SO1,P1,11,20200105,20200106,20200107\n"
        ",31.00,2,SO2,P1,11,20200105,20200106,20200107\n"
        "n/a,5,1,SO3,P1,11,20200105,20200106,20200107\n")
    run = Pipeline(spark, source, prefix="wide_", location=str(tmp_path / "wide"), blocking=frozenset())
    run.run()
    assert rows(run.table("gold", "fact_sales"), "order_number", "sales_amount", "quantity", "price") == [
        ("SO1", Decimal(7650000000051), 300000000002, 25.5), ("SO2", Decimal(31), 2, 15.5),
        ("SO3", Decimal(5), 1, 5.0)]
    silver = run.table("silver", "crm_sales")
    assert silver.where("_source_file LIKE '%sales_details.csv'").count() == 3
    assert "_rejected" not in silver.columns
    found = spark.table(run.checks_table).where(
        "check_name = 'Rejected Values' AND table_name = 'crm_sales_details'").first()
    assert found.status == V.WARNING and '"rejected_values":1' in found.measures


def test_checked_reading_refuses_a_missing_column(spark, tmp_path):
    path = tmp_path / V.SOURCE_FILES["crm_cust_info"]
    path.parent.mkdir()
    path.write_text("cst_id,cst_key\n1,A\n")
    with pytest.raises(ValueError, match="cst_firstname"):
        csv_files.read_source(spark, str(tmp_path), "crm_cust_info", checked=True)


def test_pipeline_end_to_end(spark, source, tmp_path):
    p = Pipeline(spark, source, prefix="e2e_", location=str(tmp_path / "db"),
                 blocking=frozenset(), as_of=dt.date(2026, 1, 1))
    log = p.run()
    assert rows(p.table("gold", "dim_customers"), "customer_key", "customer_id", "country",
                "gender", "birthdate") == [
        (1, None, None, "Male", None), (2, 11, "United States", "Female", dt.date(1980, 1, 1))]
    assert rows(p.table("gold", "dim_products"), "product_key", "product_id", "category",
                "start_date") == [
        (1, 1, "Accessories", dt.date(2007, 12, 28)), (2, 2, "Accessories", dt.date(2013, 7, 1))]
    assert rows(p.table("gold", "fact_sales"), "order_number", "product_key", "customer_key",
                "order_date", "sales_amount") == [("SO1", 2, 2, dt.date(2020, 1, 5), 30)]
    scores = {r.task_name: r.quality_score for r in log.collect()}
    assert len(scores) == 10
    assert scores[V.TASK_BRONZE_CRM] == 80
    assert scores["Quality_Silver_CRM_Sales"] == 100
    assert scores[V.TASK_GOLD_DIMENSIONS] == 80
    assert scores[V.TASK_GOLD_FACT] == 30  # the negative sale is missing: count and revenue
    p.run()  # full refresh of the layers, appended log
    assert log.sparkSession.table(p.log_table).count() == 20
    assert p.table("gold", "fact_sales").count() == 1


def test_pipeline_gate_blocks_on_gold_only(spark, source, tmp_path):
    p = Pipeline(spark, source, prefix="gate_", location=str(tmp_path / "db"))
    with pytest.raises(QualityGateError, match="Record count mismatch"):
        p.run()
    assert spark.table(p.log_table).count() == 10  # logged before the gate closes


def test_schemas_tables_and_preview(spark, tmp_path):
    made = tables.create_schemas(spark, prefix="st_", location=str(tmp_path))
    assert made == ["st_bronze", "st_silver", "st_gold", "st_monitoring"]
    tables.create_schemas(spark, prefix="st_", location=str(tmp_path))  # again: nothing happens
    status = tables.schema_status(spark, [*made, "st_absent"])
    assert rows(status) == sorted([*[(m, True) for m in made], ("st_absent", False)], key=repr)
    comment = spark.catalog.getDatabase("st_gold").description
    assert comment == V.LAYER_SCHEMAS["gold"]

    tables.save_table(spark.range(3), "st_gold.t")
    tables.save_table(spark.range(5).selectExpr("id AS other"), "st_gold.t", overwrite_schema=True)
    tables.save_table(spark.range(2).selectExpr("id AS other"), "st_gold.t", mode="append")
    df = tables.read_table(spark, "st_gold.t")
    assert df.columns == ["other"] and df.count() == 7
    assert rows(tables.preview(df, ["other"], 3)) == [(0,), (0,), (1,)]
    total = tables.query(spark, "SELECT sum(other) AS s FROM {t} WHERE other > :low",
                         {"low": 1}, t=df)
    assert total.first().s == 9
    tables.drop_table(spark, "st_gold.t")
    tables.drop_table(spark, "st_gold.t")
    assert not spark.catalog.tableExists("st_gold.t")


def test_staged_rows_are_in_the_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder and new_path(spark, "x").startswith(folder)
    df = stage(spark.range(5).withColumn("r", F.rand()), "random")
    assert all(folder in f for f in df.inputFiles())
    assert rows(df) == rows(df)  # written once, so reads agree
    release(spark)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0]).count()


def test_a_cluster_without_shared_folder_is_refused(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    tables.create_schemas(spark, {"counted": "x"}, location=str(tmp_path))
    df = spark.range(1_000).withColumn("k", F.col("id") % 7)
    wide = df.join(df.groupBy("k").count(), "k")  # observed above a shuffle
    assert tables.save_counted(wide, "counted.wide") == 1_000
    assert tables.save_counted(df.where("id < 0"), "counted.nothing") == 0
    assert tables.save_counted(df, "counted.parted", partition_by=["k"]) == spark.table("counted.parted").count()
    spark.sql("DROP DATABASE counted CASCADE")


def test_a_run_writes_the_verdicts_of_all_layers(spark, source, tmp_path):
    run = Pipeline(
        spark, source, prefix="checked_", location=str(tmp_path / "tables"), blocking=frozenset())
    run.run()
    found = spark.table(run.checks_table)
    assert rows(found.select("layer").distinct()) == [("BRONZE",), ("GOLD",), ("SILVER",)]
    assert found.where("status IS NULL OR measures IS NULL OR check_name IS NULL").count() == 0
    for (layer, table), n in run.counts.items():
        assert n == run.table(layer, table).count()
    read = found.where("layer = 'SILVER'").selectExpr(
        "table_name", "get_json_object(measures, '$.bronze_count') AS b", "get_json_object(measures, '$.silver_count') AS s")
    want = {(V.SILVER_TABLES[t], str(run.counts["bronze", t])) for t in V.SOURCE_FILES}
    assert want <= {(r.table_name, r.b) for r in read.collect()}

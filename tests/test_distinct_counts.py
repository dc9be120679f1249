from conftest import rows

from stratamart import fixed_values as V
from stratamart.operators import checks, distinct_counts

KEYS = {"crm_cust_info": [["cst_id"], ["cst_id", "cst_key"]]}


def load(spark, low, high):
    return {"crm_cust_info": spark.range(low, high).selectExpr(
        "CASE WHEN id % 10 <> 0 THEN id END AS cst_id", "concat('K', id) AS cst_key")}


def recorded(spark, path, *loads):
    for number, (low, high) in loads:
        distinct_counts.record_load(
            distinct_counts.load_sketches(load(spark, low, high), KEYS, number), path)
    return spark.read.parquet(path)


def test_merged_sketches_are_within_their_bound_and_skip_null_keys(spark, tmp_path):
    log = recorded(spark, str(tmp_path / "s"), (1, (0, 30_000)), (2, (20_000, 60_000)), (3, (0, 0)))
    found = {r.key_columns: r for r in distinct_counts.distinct_counts(log).collect()}
    for r in found.values():
        assert (r.loads, r.row_count) == (3, 70_000)
        assert abs(r.distinct_keys - 54_000) <= r.error_bound < 54_000 * 0.03


def test_a_load_that_comes_again_or_is_taken_back(spark, tmp_path):
    path = str(tmp_path / "s")
    once = rows(distinct_counts.distinct_counts(recorded(spark, path, (1, (0, 900)), (2, (900, 2_000)))))
    again = recorded(spark, path, (2, (900, 2_000)))
    assert rows(distinct_counts.distinct_counts(again)) == once
    first = distinct_counts.distinct_counts(again.where("load_id = 1")).where("key_columns = 'cst_id'").first()
    assert (first.loads, first.row_count) == (1, 900) and abs(first.distinct_keys - 810) <= first.error_bound


def test_loads_without_keys_count_nothing(spark, tmp_path):
    log = recorded(spark, str(tmp_path / "s"), (1, (0, 0)))
    assert {(r.row_count, r.distinct_keys, r.error_bound) for r in distinct_counts.distinct_counts(log).collect()} == {(0, 0, 0)}


def test_the_ingestion_check_from_sketches_has_the_verdict_of_the_rows(spark, tmp_path):
    log = recorded(spark, str(tmp_path / "s"), (1, (0, 700)), (2, (700, 1_500))).where("key_columns = 'cst_id'")
    got = distinct_counts.ingestion_over_loads(log, ["crm_cust_info"]).first()
    want = checks.ingestion_check(load(spark, 0, 1_500)).first()
    assert (got.record_count, got.status, got.message) == (want.record_count, want.status, want.message)
    assert got.status == V.PASS and abs(got.unique_keys - want.unique_keys) <= 0.025 * want.unique_keys

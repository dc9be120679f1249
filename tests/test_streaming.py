import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratamart.operators.silver import silver_location
from stratamart.schemas import BRONZE_SCHEMAS
from stratamart.streaming import ingest, upsert


def test_stream_takes_each_file_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def arrive(name, *lines):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join(["CID,CNTRY", *lines]) + "\n")

    def run():
        stream = ingest.stream_files(
            spark, source, BRONZE_SCHEMAS["erp_loc_a101"], source="erp_loc_a101")
        ingest.ingest_stream(stream, silver_location, out, state).awaitTermination()
        return rows(spark.read.parquet(out), "customer_number", "country", "_source_table")

    arrive("a.csv", "AW-1,US", "AW-2,")
    first = [("AW1", "United States", "erp_loc_a101"), ("AW2", "n/a", "erp_loc_a101")]
    assert run() == first
    assert run() == first  # nothing new
    arrive("b.csv", "AW-3,France")
    assert run() == [*first, ("AW3", "France", "erp_loc_a101")]


CHANGES = "k string, seq long, v string, gone boolean"


def changes(spark, *data):
    return spark.createDataFrame(list(data), CHANGES)


def test_apply_changes(spark):
    target = changes(spark, ("a", 1, "old", None), ("b", 1, "keep", None), ("c", 5, "new", None))
    feed = changes(spark, ("a", 2, "mid", False), ("a", 3, "last", False), ("c", 4, "late", False),
                   ("d", 1, "in", False), ("b", 2, None, True))
    assert rows(upsert.apply_changes(target, feed, ["k"], ["seq"], "gone"), "k", "v") == [
        ("a", "last"), ("c", "new"), ("d", "in")]
    assert upsert.apply_changes(target, feed, ["k"], ["seq"]).count() == 4


@pytest.fixture()
def feed(spark, tmp_path):
    source, log, state = (str(tmp_path / n) for n in ("feed", "log", "state"))

    def push(*data):
        changes(spark, *data).coalesce(1).write.mode("append").parquet(source)
        stream = ingest.stream_files(spark, source, changes(spark).schema, "parquet")
        upsert.start_upsert(stream, log, state, ["k"], ["seq"]).awaitTermination()

    return push, log


def current(spark, log):
    return rows(upsert.current_rows(spark, log, ["k"], ["seq"], "gone"), "k", "seq", "v")


def test_upsert_over_batches(spark, feed):
    push, log = feed
    push(("a", 1, "x", False), ("a", 2, "y", False), ("b", 1, "z", False))
    assert current(spark, log) == [("a", 2, "y"), ("b", 1, "z")]
    push(("a", 1, "late", False), ("b", 2, None, True), ("c", 1, "c", False))
    assert current(spark, log) == [("a", 2, "y"), ("c", 1, "c")]
    push(("a", 2, "same sequence, later batch", False))
    assert current(spark, log)[0] == ("a", 2, "same sequence, later batch")
    assert spark.read.parquet(log).where("batch_id = 0").count() == 2  # only the latest per key


def test_a_batch_that_runs_again_replaces_itself(spark, feed):
    push, log = feed
    push(("a", 1, "x", False))
    before = current(spark, log)
    again = changes(spark, ("a", 1, "x", False))
    again.write.mode("overwrite").parquet(f"{log}/batch_id=0")
    assert current(spark, log) == before


def test_compaction_keeps_the_current_rows(spark, feed, tmp_path):
    push, log = feed
    push(("a", 1, "x", False), ("b", 1, "y", False))
    push(("a", 2, "z", False), ("b", 2, None, True))
    new = str(tmp_path / "compacted")
    out = upsert.compact(spark, log, new, ["k"], ["seq"], "gone")
    assert rows(out, "k", "v") == [("a", "z")]
    changes(spark, ("a", 3, "later", False)).write.parquet(f"{new}/batch_id=7")
    assert current(spark, new) == [("a", 3, "later")]


def test_silver_functions_stream_as_they_are(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = ingest.stream_files(spark, str(tmp_path / "in"), BRONZE_SCHEMAS["erp_loc_a101"])
    assert silver_location(stream).isStreaming
    assert silver_location(stream).withColumn("x", F.lit(1)).columns[-1] == "x"


def test_a_deleted_key_stays_gone_after_compaction(spark, tmp_path):
    log, new = str(tmp_path / "log"), str(tmp_path / "new")
    kinds = "k string, v string, seq long, gone boolean"
    spark.createDataFrame([("a", "old", 1, False), ("b", "x", 1, False)], kinds).write.parquet(
        f"{log}/{upsert.BATCH}=0")
    spark.createDataFrame([("a", None, 5, True)], kinds).write.parquet(f"{log}/{upsert.BATCH}=1")
    assert rows(upsert.compact(spark, log, new, ["k"], ["seq"], "gone"), "k") == [("b",)]
    spark.createDataFrame([("a", "late", 3, False)], kinds).write.parquet(f"{new}/{upsert.BATCH}=2")
    assert rows(upsert.current_rows(spark, new, ["k"], ["seq"], "gone"), "k") == [("b",)]

import pytest
from conftest import planned, rows
from pyspark.sql import functions as F

from stratamart.operators import joins
from stratamart.operators.joins import HotKeys, find_hot_keys, hot_keys_for, left_lookup


@pytest.fixture()
def sides(spark):
    i = F.col("id")
    left = spark.range(2000).select(
        F.when(i % 3 == 0, "hot").when(i % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), (i % 50).cast("string"))).alias("k"),
        (i % 4).alias("v"),
    )
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), (None, 5)], "rk string, w int")
    return left, right


def plain(left, right):
    return left.join(right, left["k"] == right["rk"], "left").drop("rk")


@pytest.mark.parametrize("hot_right", [
    None, HotKeys(), HotKeys(["hot"], False, 5), HotKeys(["k1", "hot"], True, 3),
])
@pytest.mark.parametrize("hot", [
    None, HotKeys(), HotKeys(["hot"], False, 4), HotKeys(["hot", "k1"], True, 7),
    HotKeys([], True, 3), HotKeys(["absent"], False, 2),
])
def test_salting_never_changes_the_result(sides, hot, hot_right, no_broadcast):
    left, right = sides
    got = left_lookup(left, right, "k", "rk", hot=hot, hot_right=hot_right)
    assert rows(got) == rows(plain(left, right))


def test_a_hot_right_key_is_found_and_spread(spark, no_broadcast):
    i = F.col("id")
    right = spark.range(3000).select(
        F.when(i % 3 == 0, "hot").otherwise(i.cast("string")).alias("rk"), i.alias("w"))
    left = spark.createDataFrame([("hot", 1), ("1", 2), ("none", 3), (None, 4)], "k string, v int")
    assert joins.hot_right_keys(right, "rk") is None  # small
    found = find_hot_keys(right, "rk", hot_rows=100, rows_per_salt=100)["rk"]
    assert found.values == ["hot"] and found.salts == 10
    got = left_lookup(left, right, "k", "rk", hot_right=found)
    assert rows(got) == rows(plain(left, right))


def test_hot_keys_are_found_with_bounded_memory(sides):
    left, _ = sides
    found = find_hot_keys(left, "k", hot_share=0.05, hot_rows=10, rows_per_salt=100)["k"]
    assert found.values == ["hot"] and found.nulls
    assert found.salts == 7  # 667 rows of it, 100 per salt
    assert not find_hot_keys(left, "k", hot_rows=10**6)["k"]


def test_hot_keys_of_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    assert not find_hot_keys(empty, "k", hot_rows=0)["k"]


def test_no_search_where_spark_broadcasts(spark, sides, tmp_path):
    left, right = sides
    right.write.parquet(str(tmp_path / "r"))
    small = spark.read.parquet(str(tmp_path / "r"))
    assert joins.spark_will_broadcast(small)
    assert hot_keys_for(left, ("k", small), small_left=0) == {}


def test_search_where_spark_shuffles(sides, no_broadcast):
    left, right = sides
    assert set(hot_keys_for(left, ("k", right), ("v", right), small_left=0)) == {"k", "v"}
    assert hot_keys_for(left, ("k", right)) == {}  # too small to matter


def test_salted_rows_of_a_hot_key_go_to_several_partitions(sides, no_broadcast):
    left, right = sides
    out = left_lookup(left, right, "k", "rk", hot=HotKeys(["hot"], True, 8))
    out.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = out.withColumn("p", F.spark_partition_id())
        hot_parts = placed.where("k = 'hot'").select("p").distinct().count()
        null_parts = placed.where("k IS NULL").select("p").distinct().count()
        assert hot_parts > 2 and null_parts > 2
    finally:
        out.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    assert "CartesianProduct" not in planned(out)
    assert "NestedLoop" not in planned(out)


def test_sizes_are_read_as_spark_writes_them():
    assert joins._as_bytes("10485760") == 10485760
    assert joins._as_bytes("10MB") == 10 * 2**20
    assert joins._as_bytes("10485760b") == 10485760
    assert joins._as_bytes("1g") == 2**30
    assert joins._as_bytes("-1") == -1

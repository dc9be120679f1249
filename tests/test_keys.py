from urllib.parse import unquote, urlparse

import pyarrow.parquet as pq
import pytest
from conftest import final_plan, planned, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratamart.operators import keys
from stratamart.operators.keys import (
    equal_parts, latest_per_key, newest_key, number_rows, places_at,
)
from stratamart.staging import stage

RANGED = {"rows_per_partition": 150}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows are copies of one row, a tenth has no key."""
    k = F.col("id")
    return spark.range(3000).select(
        F.when(k % 3 == 0, 7).when(k % 10 == 1, None).otherwise(k % 400).alias("a"),
        F.when(k % 3 == 0, "same").otherwise(F.concat(F.lit("v"), (k % 17).cast("string")))
        .alias("b"),
        F.when(k % 3 == 0, 0.5).otherwise(k / 7).alias("c"),
    )


def expected_numbers(df):
    order = Window.orderBy(*[F.col(c).asc_nulls_first() for c in ("a", "b", "c")])
    return df.select(F.row_number().over(order).cast("long").alias("key"), "a", "b", "c")


@pytest.mark.parametrize("options", [{}, RANGED])
def test_number_rows_equals_a_global_row_number(skewed, options):
    got = number_rows(skewed, ["a"], "key", **options)
    assert got.columns == ["key", "a", "b", "c"]
    assert rows(got) == rows(expected_numbers(skewed))


def test_number_rows_order_may_be_descending(spark):
    df = spark.createDataFrame([(1,), (3,), (2,)], "a int")
    for options in ({}, {"rows_per_partition": 1}):
        got = number_rows(df, [F.col("a").desc()], "key", **options)
        assert rows(got) == [(1, 3), (2, 2), (3, 1)]


def test_number_rows_of_nothing(spark):
    empty = spark.createDataFrame([], "a int")
    assert number_rows(empty, ["a"], "key").count() == 0


def test_ranged_numbering_spreads_a_hot_value_and_gathers_no_rows(skewed):
    got = number_rows(skewed, ["a"], "key", **RANGED)
    text = planned(got)
    assert "SinglePartition" not in text
    assert "rangepartitioning" not in text  # done once, before the rows were written
    assert "SortMergeJoin" not in text
    files = {unquote(urlparse(f).path) for f in got.inputFiles()}
    parts = [pq.ParquetFile(f) for f in files]
    sizes = [p.metadata.num_rows for p in parts if "a" in p.schema_arrow.names]
    assert sum(sizes) == 3000 and len(sizes) >= 15
    assert max(sizes) < 3 * 150  # a third of the rows is 1000


@pytest.mark.parametrize("options", [{}, {"few": 40}])
@pytest.mark.parametrize("parts", [5, 7])
def test_equal_parts_equals_ntile(skewed, options, parts):
    df = skewed.distinct()
    got = equal_parts(df, parts, {"x": ["a"], "y": ["c"]}, **options)

    def tile(*first):
        rest = [c for c in df.columns if c not in first]
        order = [F.col(c).asc_nulls_first() for c in (*first, *rest)]
        return F.ntile(parts).over(Window.orderBy(*order))

    want = df.withColumn("x", tile("a")).withColumn("y", tile("c"))
    assert rows(got) == rows(want)


def test_equal_parts_with_fewer_rows_than_parts(spark):
    df = spark.createDataFrame([(3,), (1,)], "a int")
    for options in ({}, {"few": 1}):
        assert rows(equal_parts(df, 5, {"t": ["a"]}, **options)) == [(1, 1), (3, 2)]
    assert equal_parts(df.where("a > 5"), 5, {"t": ["a"]}).count() == 0


def test_equal_parts_of_copies_and_other_types(spark):
    """A third of the rows are one row; dates, times, decimals, blanks and nulls are ordered."""
    df = spark.range(900).selectExpr(
        "if(id % 3 = 0, 7, id % 50) AS a", "if(id % 3 = 0, NULL, timestamp_seconds(id * 7919)) AS t",
        "if(id % 3 = 0, 1.5BD, cast(id AS decimal(10, 2)) / 7) AS d", "array(id % 2) AS list")
    got = equal_parts(df, 4, {"x": ["t"], "y": ["d", "a"]}, few=30)
    for tile in ("x", "y"):
        assert rows(got.groupBy(tile).count()) == [(i, 225) for i in range(1, 5)]
    ends = got.groupBy("x").agg(F.min("t"), F.max("t")).orderBy("x").collect()
    assert ends[0][2] is None and all(a[2] <= b[1] for a, b in zip(ends[1:], ends[2:]))


def test_equal_parts_writes_once_and_shuffles_no_rows(skewed, monkeypatch):
    staged = []
    monkeypatch.setattr(keys, "stage", lambda df, label: staged.append(label) or stage(df, label))
    got = equal_parts(skewed, 5, {"x": ["a"], "y": ["c"], "z": ["b"]}, few=100)
    assert staged == ["tiles"] and "Exchange" not in planned(got)


def test_equal_parts_takes_names_only(skewed):
    with pytest.raises(TypeError):
        equal_parts(skewed, 5, {"x": [F.col("a").desc()]})


@pytest.mark.parametrize("few", [1, 10, 5_000])
def test_places_at_ranks(spark, few):
    places = spark.range(2_000).selectExpr("struct(id * 7919 % 2003 AS a, id AS b) AS place")
    values = sorted(r[0] for r in places.collect())
    ranks = [0, 1, 999, 1_000, 1_999, 2_000, -1]
    assert places_at(places, ranks, few, 5) == {r: values[r] for r in ranks[:5]}


def test_latest_per_key_settles_ties_and_takes_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 5, "n"), (None, None, "m"),
         ("b", None, "only")], "k string, s int, v string")
    assert rows(latest_per_key(df, ["k"], ["s"])) == sorted(
        [("a", 2, "z"), (None, 5, "n"), ("b", None, "only")], key=repr)


def test_latest_per_key_drops_rows_before_the_shuffle(skewed):
    text = planned(latest_per_key(skewed, ["a"], ["c"]))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.index("Final") < text.index("Exchange") < text.rindex("Partial")


def test_newest_key_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([("p", 1), ("p", 4), ("q", 2), (None, 9)], "n string, key long")
    out = newest_key(df, "n", "key")
    assert rows(out) == [("p", 4), ("q", 2)]
    text = final_plan(out)
    assert "partial_max" in text and "SortAggregate" not in text

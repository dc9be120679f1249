import os
import shutil

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratamart.operators import gold
from stratamart.operators.partitions import PartitionedTable, bucket_of, live, month_of
from stratamart.operators.registry import KeyRegistry
from stratamart.plans.incremental import IncrementalGold
from stratamart.schemas import BRONZE_SCHEMAS
from stratamart.staging import DROP_SHUFFLES, scratch, stage, staged_root

ROWS = "k string, d date, v int, sequence long, is_deleted boolean"


def table_rows(spark, *data):
    df = spark.createDataFrame(list(data), "k string, d string, v int, sequence long, is_deleted boolean")
    return df.withColumn("d", F.col("d").cast("date")).withColumn("order_month", month_of("d"))


def files(path):
    return {
        (os.path.relpath(folder, path), name) for folder, _, names in os.walk(path)
        for name in names if name.endswith(".parquet")}


@pytest.fixture()
def table(spark, tmp_path):
    return PartitionedTable(spark, str(tmp_path / "table"), "order_month")


def now(spark, table):
    like = table_rows(spark)
    return rows(live(table.read(like)), "k", "v", "order_month")


FIRST = [("a", "2024-01-05", 1, 1, False), ("b", "2024-02-05", 2, 1, False), ("c", None, 3, 1, False),
         ("d", "2024-03-01", 4, 1, False), (None, "2024-03-02", 5, 1, None)]


def merge(spark, table, *data, intend=list):
    return table.merge(table_rows(spark, *data), ["k"], ["sequence"], intend)


def test_merge_rewrites_touched_partitions_only(spark, table):
    assert merge(spark, table, *FIRST) == ["2024-01", "2024-02", "2024-03", "undated"]
    before = files(table.path)
    assert merge(spark, table, ("b", "2024-02-09", 20, 2, False), (None, "2024-03-02", 6, 2, False)) == [
        "2024-02", "2024-03"]
    kept = {f for f in before if f[0] in ("order_month=2024-01", "order_month=undated")}
    assert kept <= files(table.path) and not (before - kept) & files(table.path)
    assert now(spark, table) == sorted([
        ("a", 1, "2024-01"), ("b", 20, "2024-02"), ("c", 3, "undated"), ("d", 4, "2024-03"),
        (None, 6, "2024-03")], key=repr)


def test_a_row_that_moves_leaves_its_partition(spark, table):
    merge(spark, table, *FIRST)
    assert merge(spark, table, ("a", "2024-02-01", 9, 2, False)) == ["2024-01", "2024-02"]
    assert table.values() == ["2024-02", "2024-03", "undated"]  # nothing is left of January
    assert ("a", 9, "2024-02") in now(spark, table)


def test_late_changes_and_deletions(spark, table):
    merge(spark, table, *FIRST)
    merge(spark, table, ("a", "2024-01-05", 1, 5, True))
    assert merge(spark, table, ("a", "2024-01-05", 7, 4, False)) == []
    assert merge(spark, table, ("d", "2024-03-01", 4, 1, False)) == []  # the same again
    assert "a" not in [r[0] for r in now(spark, table)]
    merge(spark, table, ("a", "2024-01-06", 8, 6, False))
    assert ("a", 8, "2024-01") in now(spark, table)


def test_nothing_to_merge(spark, table):
    assert merge(spark, table) == [] and table.values() == []


@pytest.mark.parametrize("replaced", [0, 1])
def test_an_attempt_that_broke_off_is_mended(spark, table, replaced, monkeypatch):
    merge(spark, table, *FIRST)
    noted = []

    def intend(partitions):
        noted.extend(p for p in partitions if p not in noted)
        return sorted(noted)

    changes = [("a", "2024-02-01", 9, 2, False), ("b", "2024-01-01", 8, 2, False)]
    whole = PartitionedTable.replace

    def half(self, rows_, touched):  # only one of the two partitions is replaced
        one = touched[replaced]
        whole(self, rows_.where(F.col("order_month") == one), [one])
        raise OSError("lost")

    monkeypatch.setattr(PartitionedTable, "replace", half)
    with pytest.raises(OSError):
        merge(spark, table, *changes, intend=intend)
    monkeypatch.setattr(PartitionedTable, "replace", whole)
    assert merge(spark, table, *changes, intend=intend) == ["2024-01", "2024-02"]
    assert [r for r in now(spark, table) if r[0] in ("a", "b")] == [("a", 9, "2024-02"), ("b", 8, "2024-01")]


def test_merge_in_slices_gives_the_same_and_leaves_nothing_staged(spark, table, tmp_path, monkeypatch):
    sizes = []
    whole = PartitionedTable.replace

    def seen(self, rows_, touched):
        sizes.append(list(touched))
        plan = rows_._jdf.queryExecution().optimizedPlan().toString()
        assert "RebalancePartitions" not in plan and plan.count("Join") == 0  # one shuffle brings all together
        whole(self, rows_, touched)

    monkeypatch.setattr(PartitionedTable, "replace", seen)
    before = files(staged_root(spark))
    at_once = PartitionedTable(spark, str(tmp_path / "whole"), "order_month")
    later = [("a", "2024-02-01", 9, 2, False), ("b", "2024-02-05", 7, 0, False), (None, None, 6, 2, False),
             ("d", "2024-03-01", 8, 2, True), ("e", "2024-03-01", 1, 1, False), ("c", None, 4, 1, False)]
    for data in (FIRST, later):
        wanted = merge(spark, at_once, *data)
        own = table.merge(table_rows(spark, *data), ["k"], ["sequence"], slice_rows=1)
        assert own == wanted
    assert now(spark, table) == now(spark, at_once) == sorted([
        ("a", 9, "2024-02"), ("b", 2, "2024-02"), ("c", 3, "undated"), (None, 6, "undated"),
        ("e", 1, "2024-03")], key=repr)
    assert sizes[1:5] == [["2024-01"], ["2024-02"], ["2024-03"], ["undated"]]
    assert files(staged_root(spark)) == before


def test_replace_refuses_rows_of_other_partitions(spark, table):
    merge(spark, table, *FIRST)
    before = files(table.path)
    with pytest.raises(PySparkException, match="not to be replaced"):
        table.replace(table_rows(spark, *FIRST), ["2024-01"])
    assert files(table.path) == before


def test_scratch_deletes_what_is_staged_inside_only(spark):
    before, options = files(staged_root(spark)), spark.conf.get(DROP_SHUFFLES, None)
    lasting = stage(spark.range(3), "lasting")
    with pytest.raises(OSError):
        with scratch(spark):
            assert stage(spark.range(5), "inside").count() == 5
            with scratch(spark):
                stage(spark.range(7), "innermost")
            assert spark.conf.get(DROP_SHUFFLES) == "true"
            raise OSError("lost")
    assert lasting.count() == 3 and spark.conf.get(DROP_SHUFFLES, None) == options
    assert {f[0].rpartition("-")[0] for f in files(staged_root(spark)) - before} == {"lasting"}


# --- keys that stay -----------------------------------------------------------

def named(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "n string")


def test_registry_gives_old_keys_again_and_new_ones_from_the_high_water_mark(spark, tmp_path):
    registry = KeyRegistry(spark, str(tmp_path), ["n"], "key")
    assert rows(registry.assign(named(spark, "m", "c", "c"), 0)) == [("c", 1), ("m", 2)]
    assert rows(registry.assign(named(spark, "a", "m", None), 1)) == sorted(
        [("m", 2), (None, 3), ("a", 4)], key=repr)
    assert rows(registry.assign(named(spark), 2)) == [] and registry.high_water() == 4
    assert rows(registry.assign(named(spark, None, "z"), 3)) == sorted([(None, 3), ("z", 5)], key=repr)
    assert rows(registry.keys(named(spark))) == sorted(
        [("c", 1), ("m", 2), (None, 3), ("a", 4), ("z", 5)], key=repr)


def test_a_batch_that_runs_again_gives_the_same_keys(spark, tmp_path):
    registry = KeyRegistry(spark, str(tmp_path), ["n"], "key")
    registry.assign(named(spark, "c", "b"), 0)
    first = rows(registry.assign(named(spark, "a", "d", "b"), 1))
    assert rows(registry.assign(named(spark, "a", "d", "b"), 1)) == first
    assert registry.high_water() == 4


def test_one_percent_of_new_rows_changes_no_key_and_shuffles_no_old_one(spark, tmp_path):
    registry = KeyRegistry(spark, str(tmp_path), ["n"], "key")
    many = spark.range(20_000).select(F.concat(F.lit("n"), "id").alias("n"))
    before = dict(rows(registry.assign(many, 0)))
    more = spark.range(19_900, 20_100).select(F.concat(F.lit("n"), "id").alias("n"))
    given = registry.assign(more, 1)
    after = dict(rows(registry.keys(more)))
    assert all(after[n] == k for n, k in before.items())
    assert sorted(after.values()) == list(range(1, 20_101)) and given.count() == 200
    known = registry.keys(more, 1).join(more, "n", "left_semi")
    known.collect()
    plan = known._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


# --- all layers -----------------------------------------------------------------

def bronze(spark, name, *data):
    kinds = ", ".join(f"{f.name} string" for f in BRONZE_SCHEMAS[name].fields)
    df = spark.createDataFrame(
        [tuple(None if c is None else str(c) for c in r[:-2]) + r[-2:] for r in data],
        f"{kinds}, sequence long, is_deleted boolean")
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMAS[name].fields],
        "sequence", "is_deleted")


def customer(i, sequence, name="x", gone=False):
    return (i, f"AW{i}", name, "y", "M", "F", "2020-01-01", sequence, gone)


def product(i, number, start, sequence, gone=False):
    return (i, f"AC-HE-{number}", "helmet", 5, "R", start, None, sequence, gone)


def sale(order, number, who, date, amount, sequence, gone=False):
    return (order, number, who, date, date, date, amount, 1, amount, sequence, gone)


BATCHES = [
    dict(customers=[customer(1, 1), customer(2, 1)], products=[product(10, "P1", "2020-01-01", 1)],
         sales=[sale("SO1", "P1", 1, 20240105, 10, 1), sale("SO2", "P1", 3, 20240205, 20, 1),
                sale("SO3", "P2", 2, 20240305, 30, 1), sale("SO4", "P9", 2, 0, 40, 1)]),
    dict(customers=[customer(3, 2), customer(1, 2, "new name")], products=[product(11, "P2", "2020-01-01", 2)],
         sales=[sale("SO1", "P1", 1, 20240405, 11, 2), sale("SO5", "P1", 1, 20240106, 50, 2)]),
    dict(customers=[customer(2, 3, gone=True)], products=[product(9, "P1", "2021-01-01", 3)],
         sales=[sale("SO2", "P1", 3, 20240205, 0, 3, True), sale("SO1", "P1", 1, 20240105, 9, 1)]),
]


def opened(spark, path):
    people = spark.createDataFrame([], "customer_number string, birth_date date, gender string")
    places = spark.createDataFrame([("AW1", "France")], "customer_number string, country string")
    kinds = spark.createDataFrame(
        [("AC_HE", "Accessories", "Helmets", True)],
        "category_id string, category string, subcategory string, maintenance_flag boolean")
    return IncrementalGold(spark, str(path), people, places, kinds, buckets=4)


@pytest.fixture(scope="module")
def applied(spark, tmp_path_factory):
    """Folders after the first and after the second batch, and what each touched."""
    root = tmp_path_factory.mktemp("applied")
    first = opened(spark, root / "one").apply(0, **frames(spark, BATCHES[0]))
    shutil.copytree(root / "one", root / "two")
    second = opened(spark, root / "two").apply(1, **frames(spark, BATCHES[1]))
    return root, [first, second]


@pytest.fixture()
def model(spark, applied, tmp_path):
    def make(batches=None):
        if batches:
            shutil.copytree(applied[0] / batches, tmp_path / "gold")
        return opened(spark, tmp_path / "gold")

    return make


def frames(spark, batch):
    names = {"customers": "crm_cust_info", "products": "crm_prd_info", "sales": "crm_sales_details"}
    return {k: bronze(spark, names[k], *v) for k, v in batch.items()}


def state(model):
    """The fact by natural keys, and the customers."""
    fact = model.fact_sales()
    products = model.dimension("products").select("product_key", F.col("natural_key").alias("product"))
    customers = model.dimension("customers").select("customer_key", F.col("natural_key").alias("customer"))
    named = fact.join(products, "product_key", "left").join(customers, "customer_key", "left")
    return (
        rows(named, "order_number", "product", "customer", "sales_amount", "order_month"),
        rows(model.dimension("customers"), "natural_key", "firstname", "country"))


WANT = (
    [("SO1", 9, "AW1", 11, "2024-04"), ("SO3", 11, None, 30, "2024-03"), ("SO4", None, None, 40, "undated"),
     ("SO5", 9, "AW1", 50, "2024-01")],
    [("AW1", "new name", "France"), ("AW3", "x", None)],
)


def test_three_batches_give_what_the_final_rows_say(spark, model, applied):
    touched = [*applied[1], model("two").apply(2, **frames(spark, BATCHES[2]))]
    assert touched[0]["fact"] == ["2024-01", "2024-02", "2024-03", "undated"]
    # January loses SO1 and gains SO5, April gains SO1, February gets its customer, March its product.
    assert touched[1]["fact"] == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert touched[2]["sales"] == ["2024-02"]
    # P1 has a newer version, customer 2 is gone: every month with their sales.
    assert touched[2]["fact"] == ["2024-01", "2024-02", "2024-03", "2024-04", "undated"]
    last = model()
    assert last.apply(2, **frames(spark, BATCHES[2]))["fact"] == []  # recorded: without effect
    assert state(last) == WANT


def test_months_without_changes_keep_their_files(spark, model, tmp_path):
    own = model("one")
    before = files(str(tmp_path / "gold" / "fact_sales"))
    only = dict(customers=[], products=[], sales=[sale("SO2", "P1", 3, 20240206, 21, 2)])
    assert own.apply(1, **frames(spark, only))["fact"] == ["2024-02"]
    after = files(str(tmp_path / "gold" / "fact_sales"))
    assert {f for f in before if "2024-02" not in f[0]} == {f for f in after if "2024-02" not in f[0]}


def test_the_fact_is_built_a_few_months_at_a_time(spark, model, applied, monkeypatch):
    own, built = model("one"), []
    own.slice_rows = 1
    whole = own._fact_rows
    monkeypatch.setattr(own, "_fact_rows", lambda months: built.append(list(months)) or whole(months))
    before = files(staged_root(spark))
    months = own.apply(1, **frames(spark, BATCHES[1]))["fact"]
    assert built == [[m] for m in months] and len(months) == 4
    assert files(staged_root(spark)) == before
    at_once = opened(spark, applied[0] / "two")
    at_once._like = own._like
    assert rows(own.fact_sales()) == rows(at_once.fact_sales())


@pytest.mark.parametrize("after", ["sales", "dimension"])
def test_a_batch_that_broke_off_runs_again(spark, model, after, monkeypatch):
    broken = model("two")

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(broken, "_update_dimension" if after == "sales" else "_fact_rows", lost)
    with pytest.raises(OSError):
        broken.apply(2, **frames(spark, BATCHES[2]))
    last = model()
    last.apply(2, **frames(spark, BATCHES[2]))
    assert state(last) == WANT


def test_buckets_hold_null_keys(spark):
    df = spark.createDataFrame([(None,), ("a",)], "k string").withColumn("b", bucket_of(8, "k"))
    assert df.where("b IS NULL OR b < 0 OR b > 7").count() == 0


def test_gold_rows_carry_asked_columns(spark):
    sales = spark.createDataFrame(
        [("SO1", "P1", 1, None, None, None, 5, 1, 5.0, "x")],
        "order_number string, product_number string, customer_id long, order_date date, ship_date date, "
        "due_date date, sales_amount int, quantity int, price double, mark string")
    products = spark.createDataFrame([("P1", 7)], "product_number string, product_key long")
    customers = spark.createDataFrame([(1, 8)], "customer_id long, customer_key long")
    out = gold.fact_sales(sales, products, customers, keep=["mark", "product_number"])
    assert rows(out, "product_key", "customer_key", "mark", "product_number") == [(7, 8, "x", "P1")]

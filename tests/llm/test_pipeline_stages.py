"""The pipeline's stages on odd documents, and its run on the test tables."""

from collections import Counter

import corpus_pipeline
from conftest import TEST_DATA
from pyspark.sql import functions as F
from test_operators import line_counts, odd_documents, plain

from stratamart.llm import mixing, packing, quality_knn


def test_stages_return_documents(spark):
    for empty in (False, True):
        docs = odd_documents(spark, empty)
        for name, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, docs, TEST_DATA)
            assert out.dtypes == docs.dtypes, name
            out.collect()


def test_decisions_take_effect(spark):
    docs = odd_documents(spark)
    kept = corpus_pipeline.lines(spark, docs, TEST_DATA)
    assert sorted((r["text"] for r in kept.collect())) == sorted(t for *_, t in line_counts(plain(docs)))
    assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
    one = corpus_pipeline.near_duplicates(spark, docs, TEST_DATA)
    ids = Counter(r["doc_id"] for r in one.collect())
    assert 6 in ids and 7 not in ids and ids[None] == 3
    mixed = corpus_pipeline.mixture(spark, docs, TEST_DATA)
    taken = {r["row"]: r for r in mixing.mix(docs).collect()}
    whole = {r["row"]: r["copies"] for r in mixing.land_whole(mixing.mix(docs)).collect()}
    assert mixed.count() == sum(whole.values())
    assert {r["text"] for r in mixed.collect()} <= {r["text"] for r in docs.collect()}
    for k, r in taken.items():
        assert 0 <= whole.get(k, 0) - r["copies"] <= (r["taken"] > r["copies"] * r["size"])


def test_rows_that_share_an_id_are_judged_apart(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "AXYN"}
    rows = [(1, text["A"]), (2, text["X"]), (2, text["Y"]), (2, text["A"]), (None, text["N"]), (None, text["N"])]
    docs = spark.createDataFrame(
        [(i, t, "s", "c") for i, t in rows], "doc_id long, text string, node string, row string")
    got = corpus_pipeline.near_duplicates(spark, docs, TEST_DATA).collect()
    assert Counter((r["doc_id"], r["text"][0]) for r in got) == {(1, "A"): 1, (2, "X"): 1, (2, "Y"): 1, (None, "N"): 1}
    assert {(r["node"], r["row"]) for r in got} == {("s", "c")}


def test_the_last_documents_land_whole(spark):
    mixed = spark.createDataFrame(
        [(1, "a", 10, 4, 0), (2, "a", 20, 18, 0), (3, "b", 7, 10, 1), (4, None, 5, 5, 1), (5, "c", 9, 0, 0)],
        "row long, source string, size long, taken long, copies int")
    got = {r["row"]: r["copies"] for r in mixing.land_whole(mixed).collect()}
    assert got == {2: 1, 3: 1, 4: 1}


def test_columns_named_as_those_inside(spark):
    docs = spark.createDataFrame(
        [(1, "a b\nc", "s", "v")], "doc_id long, text string, source string, lang string")
    for name in ("_id", "_mark", "_keys", "_own", "_out", "_text_mark", "_doc", "row", "copies", "turn", "_row", "_one"):
        docs = docs.withColumn(name, F.lit("v"))
    for step in (corpus_pipeline.lines, corpus_pipeline.near_duplicates, corpus_pipeline.mixture):
        out = step(spark, docs, TEST_DATA)
        assert out.columns == docs.columns
        assert all(set(r[4:]) == {"v"} for r in out.collect())


def test_run(spark):
    rows = corpus_pipeline.run(spark, TEST_DATA).collect()
    assert rows and all(r["offset"] + r["length"] <= 4096 for r in rows)
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet")
    labels = spark.read.parquet(f"{TEST_DATA}/labels.parquet")
    model = quality_knn.fit_quality(docs, labels, corpus_pipeline.fold(F.col("doc_id"), 3) != 1)
    texts = docs.collect()
    accepted = {
        r["doc_id"] for r in texts
        if quality_knn.scores(model, quality_knn.term_counts(r["text"])[None])[0] >= 0.5}
    assert {r["doc_id"] for r in rows} <= accepted
    assert packing.CAPACITY == 4096

"""Every operator on odd rows, and against brute force on small ones."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stratamart.llm import (
    line_dedup, minhash, mixing, nearest, packing, quality_knn, quality_rules, substring_dedup, toxicity,
    url_filter,
)
from stratamart.llm.components import components
from stratamart.llm.packing import pack_histogram

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SPACE = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, _salt string, n int"


def words(text):
    return (text or "").encode().split()


def odd_documents(spark, empty=False):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    draw = random.Random(11)
    vocabulary = ["".join(draw.choice("abcdefg") for _ in range(draw.randint(2, 8))) for _ in range(300)]

    def text(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    long, shared = text(9_000), text(60)
    rows = [
        (None, None), (None, text(8)), (None, text(8)), (1, None), (2, ""), (3, " \n\t "), (4, "one"),
        (5, "x" * 30_000), (6, long), (7, long), (7, long), (8, shared), (9, text(20) + "\n" + shared),
        (10, "é" * 60 + " ü\u3000ß"), (11, "Line A\nline a \n\n LINE A"), (12, "\x00\x01 b"),
    ] + [(20 + i, f"{text(5)}\nCommon  line {SPACE[i % 6]}\n{text(30)}") for i in range(14)]
    full = [(i, t, [None, "en", "de"][k % 3], [None, "a", "b"][k % 3], 1, 7, "x", 3) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame([] if empty else full, DOCS)


def plain(docs):
    return [(r["doc_id"], r["text"], r["source"], r["lang"]) for r in docs.collect()]


def line_counts(rows):
    def key(line):
        return line.strip(SPACE.encode()).lower()

    counts = Counter(k for _, t, *_ in rows for k in {key(x) for x in (t or "").encode().split(b"\n")} if k)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").encode().split(b"\n")
        kept = [x for x in lines if counts[key(x)] < 10]
        out.append((i, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
    return out


@pytest.mark.parametrize("empty", [True, False])
def test_line_dedup(spark, empty):
    docs = odd_documents(spark, empty)
    got = line_dedup.drop_repeated_lines(docs)
    assert got.columns == [*docs.columns, "_n_lines", "_n_dropped"]
    rows = [(r["doc_id"], r["_n_lines"], r["_n_dropped"], r["text"]) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(line_counts(plain(docs)), key=repr)


def test_line_dedup_first_stays(spark):
    docs = spark.createDataFrame([(3, "a\nb\na"), (1, "A\nc\na"), (2, "a")], "doc_id long, text string")
    got = line_dedup.drop_repeated_lines(docs, min_docs=2, keep_first=True)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "A\nc", 2: "", 3: "b"}


@pytest.mark.parametrize("empty", [True, False])
def test_mixing(spark, empty):
    docs = odd_documents(spark, empty)
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    sizes = Counter()
    for _, t, source, _ in plain(docs):
        sizes[source] += len(words(t))
    assert sorted((r["doc_id"], r["size"]) for r in rows if r["doc_id"]) == sorted(
        (i, len(words(t))) for i, t, *_ in plain(docs) if i)
    # Water-filling, one step at a time.
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if 2 * sizes[s] < level * weight[s]}
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        target.update({s: 2.0 * sizes[s] for s in over})
        free -= over
    taken = Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in order:
        assert abs(taken[s] - target[s]) <= 2


def test_mixing_flight_keeps_totals():
    draw = np.random.default_rng(1)
    sizes, chance = draw.integers(1, 500, 3000).astype(float), draw.uniform(0.05, 0.95, 3000)
    before = (chance.sum(), (chance * sizes).sum())
    mixing._fly(sizes, chance, draw.uniform(size=3000))
    assert ((chance > 0) & (chance < 1)).sum() <= 2
    assert chance.sum() == pytest.approx(before[0]) and (chance * sizes).sum() == pytest.approx(before[1])


@pytest.mark.parametrize("empty", [True, False])
def test_packing_round_trip(spark, empty):
    from tokenizers import Tokenizer

    docs = odd_documents(spark, empty)
    rows = packing.pack(docs, TOKENIZER).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for i, t, *_ in plain(docs):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for at in range(0, len(ids), 4096):
            piece = ids[at:at + 4096]
            want[i, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(held) == list(range(len(held)))
    for pieces in held.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096


def test_packing_wastes_little():
    draw = random.Random(2)
    counts = Counter(min(4096, max(1, int(draw.lognormvariate(6, 1)))) for _ in range(20_000))
    patterns = pack_histogram(counts)
    placed = Counter()
    for pattern, n in patterns:
        assert sum(length * times for length, times in pattern) <= 4096
        for length, times in pattern:
            placed[length] += times * n
    assert placed == counts
    used = sum(k * n for k, n in counts.items())
    assert used / (4096 * sum(n for _, n in patterns)) > 0.99


RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"))


def test_url_filter(spark):
    rows = [
        (1, "http://A.example.com/en/1?q", None), (2, "https://www.example.com/en/x", ""), (3, None, None),
        (4, "no url", "x"), (5, "http://bad.net/es/1", '<a href="//friend.org/x">'), (5, "http://bad.net/es/1", None),
        (6, "http://linker.org/1", '<a HREF=\'http://bad.net/y\'><a href="/own">'), (7, "http://other.org", None),
        (8, "x://notcom/", None), (9, "http://com/", None),
    ]
    pages = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, RULES).collect()}
    assert [got[i]["rule"] for i in range(1, 10)] == [
        "example.com/en/", "www.example.com/en/", None, None, "net/es/", None, None, None, "com/"]
    assert (got[1]["host"], got[1]["path"], got[3]["host"], got[4]["path"]) == ("a.example.com", "/en/1", "", "")
    # A host that links to a blocked one alone takes 0.85 of its distrust.
    assert got[6]["distrust"] == pytest.approx(0.85) and got[6]["verdict"] == "block"
    assert [got[i]["verdict"] for i in (1, 2, 3, 4, 5, 7, 8)] == ["block", "allow", "allow", "allow", "block", "allow", "allow"]
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


def test_a_farm_of_hosts_that_link_to_a_blocked_one_is_blocked(spark):
    rows = [(k, f"http://farm{k}.org/", '<a href="http://bad.net/x">') for k in range(1_000)]
    rows += [(2_000, "http://bad.net/es/1", None), (2_001, "http://www.a.com/", '<a href="http://bad.net/x">'),
             (2_002, "http://apart.org/", '<a href="http://www.a.com/">')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages, RULES).collect()}
    assert {got[k] for k in (*range(1_000), 2_000)} == {"block"}
    assert (got[2_001], got[2_002]) == ("allow", "allow")


def test_page_rank_against_matrix(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 3), ("d", "a", 1)]
    seeds = [("a", 0.5, 0.0), ("d", 0.0, 1.0), ("c", 0.0, 0.25)]
    got = url_filter.propagate(
        spark.createDataFrame(edges, "src string, dst string, n long"),
        spark.createDataFrame(seeds, "host string, good double, bad double")).collect()
    names = "abcd"
    weight = np.zeros((4, 4))
    for s, d, n in edges:
        weight[names.index(s), names.index(d)] = n
    out = np.nan_to_num(weight / weight.sum(axis=1, keepdims=True))
    back = np.nan_to_num(weight / weight.sum(axis=0, keepdims=True)).T
    back *= 1 - np.array([0.5, 0, 0, 0])[:, None]  # a trusted host passes on less distrust
    trust = np.linalg.solve(np.eye(4) - 0.85 * out.T, [0.5, 0, 0, 0])
    distrust = np.linalg.solve(np.eye(4) - 0.85 * back.T, [0, 0, 0.25, 1])
    for r in got:
        k = names.index(r["host"])
        assert r["trust"] == pytest.approx(trust[k], abs=1e-4)
        assert r["distrust"] == pytest.approx(distrust[k], abs=1e-4)


def reference_metrics(text):
    found = (text or "").encode().split()
    windows = list(zip(found, found[1:], found[2:]))
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(found), sum(len(w.decode()) for w in found), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered))


def test_quality_rules(spark):
    docs = odd_documents(spark)
    got = quality_rules.apply_rules(docs)
    assert got.columns == [*docs.columns, "_judged"]
    for r in got.collect():
        j, want = r["_judged"], reference_metrics(r["text"])
        assert tuple(j)[:5] == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert j["base_failed"] == failed and not (failed and j["kept"])
        assert 0 <= j["class_distance"] <= 1 and 0 <= j["word_distance"] <= 1
    assert quality_rules.apply_rules(odd_documents(spark, True)).count() == 0


def test_quality_rules_reject_other_words(spark):
    draw = random.Random(5)
    common = {g: [f"{g}{k}" for k in range(40)] for g in ("en", "de")}

    def text(language, share=0.3):
        return " ".join(
            draw.choice(common[language]) if draw.random() < share
            else "".join(draw.choices("abcdefghij", k=7)) for _ in range(300))

    rows = [(k, g, text(g)) for g in ("en", "de") for k in range(100)]
    rows += [(1_000 + k, "en", text("de")) for k in range(10)] + [(2_000 + k, "en", text("en", 0.0)) for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    kept = Counter((r["doc_id"] // 1_000, r["_judged"]["kept"]) for r in quality_rules.apply_rules(docs).collect())
    assert kept == {(0, True): 200, (1, False): 10, (2, False): 10}


def test_packing_takes_special_tokens_as_the_tokenizer_does():
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "x<|startoftext|>Y <|ENDOFTEXT|>", "<|EndOfText|><|endoftext|>.", "It's <|end"]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = packing.token_bytes([t.encode() for t in texts], packing.WordIds(TOKENIZER))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_takes_the_shortest_pack():
    # 6 and 5 open packs of their own; 2 goes to the pack with more room, as does 1.
    assert sorted(pack_histogram({6: 1, 5: 1, 2: 1, 1: 1}, 10)) == [([(5, 1), (2, 1)], 1), ([(6, 1), (1, 1)], 1)]


def removed_bytes(rows, length=50):
    first = {}
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    for i, t in texts:
        for q in range(len(t) - length + 1 if i is not None else 0):
            w = t[q:q + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for q in range(len(t) - length + 1 if i is not None else 0):
            if first[t[q:q + length]] < i:
                gone[q:q + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("frequent", [8, 1])
def test_substring_dedup(spark, monkeypatch, frequent):
    monkeypatch.setattr(substring_dedup, "LEAST_SEEN", frequent)
    monkeypatch.setattr(substring_dedup, "SAMPLED", frequent)
    docs = odd_documents(spark)
    got = substring_dedup.remove_repeats(docs).drop("kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(removed_bytes(plain(docs)), key=repr)
    assert substring_dedup.remove_repeats(odd_documents(spark, True)).count() == 0


def test_nearest(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(600, 24))
    rows = [(i, v.tolist(), 1, "l") for i, v in enumerate(x)]
    rows += [(1000 + i, x[3].tolist(), 1, "l") for i in range(40)]
    rows += [(2000, None, 1, "l"), (2020, [0.0] * 24, 1, "l"), (2040, [float("nan")] * 24, 1, "l"),
             (2060, [1.0, None] * 12, 1, "l"), (2080, [1.0], 1, "l"), (None, x[1].tolist(), 1, "l")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, list string")
    got = nearest.nearest(table).collect()
    ids = np.array([*range(600), *range(1000, 1040)])
    vectors = np.vstack([x, np.repeat(x[3:4], 40, 0)])
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        score = vectors @ vectors[ids == q][0]
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != q][:20]
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        hits += len({r["vec_id"] for r in mine} & {ids[k] for k in order})
        total += 20
    assert hits / total >= 0.9 and {r["query_id"] for r in got} == set(ids[ids % 20 == 0])
    assert nearest.nearest(table.limit(0)).count() == 0
    assert len(nearest.nearest(table.where("vec_id < 5")).collect()) == 4


def recall(got, ids, vectors, k=20):
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        score = vectors @ vectors[ids == q][0]
        order = [ids[i] for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        hits, total = hits + len(found[q] & set(order)), total + k
    return hits / total


@pytest.mark.parametrize("lengths", ["equal", "varied", "outlying"])
def test_nearest_meets_its_recall_with_fewer_probes_than_lists(spark, monkeypatch, lengths):
    monkeypatch.setattr(nearest, "LEAST_PROBES", 2)
    draw = np.random.default_rng(8)
    x = draw.normal(size=(4_000, 48))  # no clusters: the hardest case
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths == "varied":
        x *= draw.lognormal(0, 1, size=(4_000, 1))
    if lengths == "outlying":
        x[7] *= 3_000
        x[60] *= 1e20
        x[1_001] *= 1e160
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = nearest.nearest(table).collect()
    assert len(got) == 200 * 20
    assert recall(got, np.arange(4_000), x) >= 0.9
    top = {(r["query_id"], r["vec_id"]) for r in got if r["rank"] <= 3}
    if lengths == "outlying":  # the longest is near to every query on its side
        assert {(q, 1_001) for q in range(0, 4_000, 20) if x[q] @ x[1_001] > 0} <= top


def shingles(text):
    found = (text or "").encode().lower().split()
    if len(found) < 5:
        return {tuple(found)} - {()}
    return {tuple(found[i:i + 5]) for i in range(len(found) - 4)}


def test_minhash_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 7)
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(2000)]
    rows = [(r[0], r[1]) for r in plain(odd_documents(spark))]
    for _ in range(4):
        base = [draw.choice(vocabulary) for _ in range(120)]
        for _ in range(18):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 2, 3])):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            rows.append((draw.randrange(100, 10**9), " ".join(text)))
    docs = spark.createDataFrame([(*r, "m", 1) for r in rows], "doc_id long, text string, mark string, n int")
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    got = minhash.near_duplicates(docs, percent=85).collect()
    want = sorted(((i, len(shingles(t)), find(i) if i is not None else None) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}}


def labelled(spark, bad, good, label):
    rows = [(i, bad(i) if i % 4 == 0 else good(i)) for i in range(240)]
    docs = spark.createDataFrame(rows + [(None, "x"), (900, None), (901, "")], "doc_id long, text string")
    quality = [(i, int(i % 4 == 0)) for i in range(240)] + [(950, 1), (None, 0), (1, None)]
    return docs, spark.createDataFrame(quality, f"doc_id long, {label} int")


def sentence(i, n=40):
    draw = random.Random(i)
    return " ".join("".join(draw.choice("etaoinshr") for _ in range(draw.randint(2, 7))) for _ in range(n))


def test_toxicity(spark):
    insults = ["idiot", "moron", "worthless", "pathetic"]
    docs, labels = labelled(
        spark, lambda i: f"{sentence(i)} {insults[i // 4 % 4]} {insults[i // 8 % 4]}. {sentence(i + 999)}", sentence, "toxic")
    model = toxicity.fit_toxicity(docs, labels, F.col("doc_id") % 5 != 0)
    score = toxicity.toxicity_score(model, spark)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", score("text").alias("s")).collect()}
    held = [i for i in range(240) if i % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and got[900] == got[901] < 0.5
    odd = ["you id-iot", "such an i d i o t here", "wort-hless", "M.O.R.O.N !!", sentence(5)]
    strength = toxicity._Strength(model)
    assert (toxicity.document_scores(model, odd, strength) >= 0.5).tolist() == [True, True, True, True, False]


def test_classifiers_without_labels(spark):
    docs, labels = labelled(spark, sentence, sentence, "toxic")
    both = labels.where("toxic = 0").withColumn("quality", F.lit(1))
    flat = toxicity.toxicity_score(toxicity.fit_toxicity(docs, both, F.lit(True)), spark)
    assert {r[0] for r in docs.select(flat("text")).collect()} == {0.0}
    one = quality_knn.quality_score(quality_knn.fit_quality(docs, both, F.lit(True)), spark)
    assert {r[0] for r in docs.select(one("text")).collect()} == {0.0, 1.0}
    none = quality_knn.quality_score(quality_knn.fit_quality(docs.limit(0), both, F.lit(True)), spark)
    assert {r[0] for r in docs.select(none("text")).collect()} == {0.0, 0.5}


def test_quality_votes(spark):
    docs, labels = labelled(spark, lambda i: sentence(i, 60), lambda i: sentence(i).upper().replace(" ", "%% "), "quality")
    model = quality_knn.fit_quality(docs, labels, F.col("doc_id") % 3 != 1)
    score = quality_knn.quality_score(model, spark)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", score("text").alias("s")).collect()}
    held = [i for i in range(240) if i % 3 == 1]
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95
    assert got[900] == got[901] == 0.0
    # Block by block is the same as all at once.
    counts = np.array([quality_knn.term_counts(sentence(i)) for i in range(30)])
    whole = quality_knn.scores(model, counts)
    assert np.allclose(whole, np.concatenate([quality_knn.scores(model, counts[i:i + 7]) for i in range(0, 30, 7)]))

import hashlib

import numpy as np
import pytest

from stratamart.llm import vector_codes as V


def brute(rows, parts=8, n_entries=16, rounds=6):
    """Codes by all distances, in Python integers."""
    kept = [(i, l, [int(np.floor(4096 * x)) for x in v]) for i, l, v in rows]
    size = len(kept[0][2]) // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:n_entries]] for p in range(parts)]

    def near(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), at) for at, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [near(p, c[p])[1] for c in cut]
            for e in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own) if o == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [[near(p, c[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, label, _), e in zip(kept, error):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        (i, "".join(f"{e:02x}" for _, e in f), err, by_label[label], sha)
        for (i, label, _), f, err in zip(kept, found, error))


def coded(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    return sorted(tuple(r) for r in V.encode(table, **options).drop("label").collect())


def test_against_brute_force_with_ties_and_copies(spark):
    chance = np.random.default_rng(3)
    rows = [(i, int(chance.integers(4)) if i % 5 else None, (chance.integers(-3, 4, 16) / 4096).tolist())
            for i in range(150)]
    rows += [(1_000 + i, 9, rows[3][2]) for i in range(90)]
    assert coded(spark, rows) == brute(rows)


def test_against_brute_force_on_clusters(spark):
    chance = np.random.default_rng(5)
    centres = chance.normal(size=(20, 16))
    rows = [(i, i % 3, (centres[chance.integers(20)] + chance.normal(size=16) / 10).tolist()) for i in range(300)]
    assert coded(spark, rows) == brute(rows)


def test_pruning_is_exact_and_saves_evaluations():
    chance = np.random.default_rng(8)
    entries = chance.integers(-4_000, 4_000, (16, 8))
    parts = entries[chance.integers(16, size=4_000)] + chance.integers(-300, 300, (4_000, 8))
    pivots = V.choose_pivots(entries)
    away = V.to_pivots(parts, pivots).astype(np.float32).astype(float)
    nearest, best, evaluated = V.assign(parts, away, entries, V.to_pivots(entries, pivots))
    every = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (nearest == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert evaluated < 0.25 * every.size


def test_ties_go_to_the_lower_index():
    entries = np.array([[0, 4], [4, 0], [0, 4], [4, 4]])
    pivots = V.choose_pivots(entries)
    parts = np.array([[0, 4], [2, 2], [4, 4], [0, 0]])
    nearest, best, _ = V.assign(parts, V.to_pivots(parts, pivots), entries, V.to_pivots(entries, pivots))
    assert nearest.tolist() == [0, 0, 3, 0] and best.tolist() == [0, 8, 0, 16]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, 1, [i / 7, -i / 3] * 8) for i in range(20)]
    odd = [(50, 1, None), (51, 1, [nan] * 16), (52, 1, [inf] + [0.0] * 15), (53, 1, [None] + [0.0] * 15)]
    assert coded(spark, good + odd) == brute(good)
    assert [r[0] for r in coded(spark, good[:3] + odd)] == [0, 1, 2]


def test_unequal_lengths_count_as_zeros(spark):
    full = [(i, None, [float(i)] * 3 + [0.0] * 13) for i in range(20)]
    short = [(i, None, v[:3]) for i, _, v in full[:19]] + full[19:]
    assert coded(spark, short) == brute(full)


def test_far_components_null_ids_and_repeats(spark):
    rows = [(i, 0, [float(i)] * 8) for i in range(5)] + [(None, 0, [1e300] * 8), (None, 0, [-1e300] * 8), (2, 0, [2.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = V.encode(table.withColumn("_v", table.label).withColumn("_key", table.label), entries=4).collect()
    assert len(got) == 8 and all(r.error >= 0 for r in got)


def test_empty_table(spark):
    table = spark.createDataFrame([(1, 1, None)], "vec_id long, label int, embedding array<double>")
    result = V.encode(table)
    assert result.collect() == [] and result.columns == [
        "vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]

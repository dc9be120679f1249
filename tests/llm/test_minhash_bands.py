import random

import numpy as np
import pyarrow as pa
import pytest

from stratamart.llm import minhash
from stratamart.llm.shingles import WordHashes, shared, shingle_set


def one_tile(texts):
    """A tile of all texts, each its own component and each asking all others."""
    docs = pa.RecordBatch.from_pydict({
        "node": list(range(len(texts))), "id": list(range(len(texts))), "text": texts})
    signed = pa.Table.from_batches(list(minhash._sign(38, 5, 5)(iter([docs])))).to_pylist()
    low = [np.frombuffer(r["sig"], np.uint8)[::4].tobytes() for r in signed]
    out = []
    for asks in (0, 1):
        out.append(pa.RecordBatch.from_pydict({
            "bucket": [7] * len(texts), "tile": [0] * len(texts), "node": [r["node"] for r in signed],
            "component": [r["node"] for r in signed], "asks": [asks] * len(texts),
            "size": [r["n_shingles"] for r in signed], "sig": low, "parity": [r["parity"] for r in signed],
            "text": texts}))
    return out


def variants(n, length, seed):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10_000)}" for _ in range(length)]
    out = []
    for k in range(n):
        words = list(base)
        words[draw.randrange(8, length - 8)] = f"x{k}"
        out.append(" ".join(words))
    return out


def pairs(step, batches):
    return [(r["x"], r["c"]) for b in step(iter(batches)) for r in b.to_pylist()]


def test_a_group_of_near_copies_sends_one_pair_less_than_it_has_members():
    batches = one_tile(variants(2_000, 200, 1))
    for step in (minhash._best_first(85), minhash._forest(85, 5)):
        found = pairs(step, batches)
        assert len(found) == len(set(found)) == 1_999
        assert {a for p in found for a in p} == set(range(2_000))


def test_a_group_just_under_the_threshold_sends_no_more_pairs_than_members():
    batches = one_tile(variants(2_000, 100, 2))
    assert len(pairs(minhash._best_first(85), batches)) < 2_000
    rows = [r for b in minhash._undecided(85)(iter(batches)) for r in b.to_pylist()]
    assert len(rows) <= 4_000
    # Two texts changed within the same five words are links, the others are not.
    cache = WordHashes()
    sets = [shingle_set(t, cache) for t in variants(2_000, 100, 2)]
    found = pairs(minhash._forest(85, 5), batches)
    assert 0 < len(found) < 2_000
    for x, c in found[:200]:
        both = shared(sets[x], sets[c])
        assert 100 * both >= 85 * (len(sets[x]) + len(sets[c]) - both)


def test_forest_joins_what_all_pairs_join():
    texts = variants(150, 100, 3)
    cache = WordHashes()
    sets = [shingle_set(t, cache) for t in texts]
    root = list(range(150))
    for i in range(150):
        for j in range(i):
            both = shared(sets[i], sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                root = [root[j] if r == root[i] else r for r in root]
    got = list(range(150))
    for x, c in pairs(minhash._forest(85, 5), one_tile(texts)):
        got = [got[c] if r == got[x] else r for r in got]
    assert [got.index(r) for r in got] == [root.index(r) for r in root]


@pytest.mark.parametrize("a, b", [(3, 3), (90, 100), (130, 127), (2_000, 1_700)])
def test_parity_maps_differ_in_no_more_cells_than_the_sets(a, b):
    rng = np.random.default_rng(a + b)
    for _ in range(20):
        pool = rng.integers(0, 2**63, a + b).astype(np.uint64)
        one, other = pool[:a], pool[a // 2:a // 2 + b]
        maps = [np.frombuffer(minhash.parity(x), np.uint64)[None, :] for x in (one, other)]
        left, right = minhash._folded(*maps)
        assert np.bitwise_count(left ^ right).sum() <= len(np.setxor1d(one, other))
        assert not (minhash._folded(maps[0], maps[0])[0] ^ maps[0]).any()


def test_bytes_that_agree_by_chance_in_an_earlier_band_keep_the_pair():
    # The full minima differ in the first band, their low bytes do not.
    batches = one_tile(variants(2, 200, 4))
    assert pairs(minhash._best_first(80), batches) == [(1, 0)]
    same = [b.set_column(b.schema.get_field_index("sig"), "sig", pa.array([b.column("sig")[0].as_py()] * 2)) for b in batches]
    assert pairs(minhash._best_first(80), same) == [(1, 0)]
    assert pairs(minhash._forest(80, 5), same) == [(1, 0)]

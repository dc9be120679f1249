import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from stratamart.llm import config_packing as P
from stratamart.llm.queries import BYTE_TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTE_TOKENIZER)


def packed(packs, capacity):
    got = Counter()
    for config, n in packs:
        assert n > 0 and sum(k * times for k, times in config) <= capacity
        for k, times in config:
            got[k] += times * n
    return got


@pytest.mark.parametrize("seed", range(3))
def test_knapsack_against_all_choices(seed):
    values = np.r_[0, np.random.default_rng(seed).random(12)]
    best, first = P.knapsacks(values[None], 12)

    def most(room):
        return max([0.0] + [values[k] + most(room - k) for k in range(1, room + 1)])

    for room in range(13):
        assert best[0, room] == pytest.approx(most(room))
    filled = P._filled(3, first[0], 12)
    assert sum(k * n for k, n in filled.items()) <= 12 and filled[3] >= 1
    assert sum(values[k] * n for k, n in filled.items()) == pytest.approx(values[3] + best[0, 9])


@pytest.mark.parametrize("counts, least", [
    ({}, 0), ({5: 1}, 1), ({1024: 7}, 7), ({513: 100}, 100), ({600: 30, 424: 30}, 30),
    ({400: 300, 312: 300, 200: 300}, 270),
])
def test_program_meets_known_optima(counts, least):
    chosen, bound = P.configurations(counts)
    packs = P.whole_packs(counts, chosen)
    assert packed(packs, 1024) == Counter(counts)
    assert bound <= least + 1e-6
    assert sum(n for _, n in packs) <= least * 1.01 + 1


@pytest.mark.parametrize("times", [1, 10**6])
def test_few_sequences_whatever_the_number_of_documents(times):
    chance = random.Random(4)
    counts = Counter(chance.randint(1, 1024) for _ in range(4_000))
    counts = {k: n * times for k, n in counts.items()}
    chosen, bound = P.configurations(counts)
    packs = P.whole_packs(counts, chosen)
    assert packed(packs, 1024) == Counter(counts)
    assert bound <= sum(n for _, n in packs) <= 1.01 * bound + 2
    assert len(P.slots(packs)) < 100_000


def test_beats_best_fit_where_lengths_go_by_threes():
    chance = random.Random(1)
    counts = Counter(chance.randint(250, 500) for _ in range(3_000))
    chosen, _ = P.configurations(counts)
    whole = sum(n for _, n in P.whole_packs(counts, chosen))
    assert whole < sum(n for _, n in P._best_fit(dict(counts), [], 1024))


ALPHABET = list("ab éßŁ日1 2\n\t   \u0085\x1c\x0b.,!'-<|>") + [
    "<|endoftext|>", "'s", "'ll", "foo", " bar", "  ", "\n\n", "Größe"]


def test_ids_are_those_of_the_tokenizer(tokenizer):
    chance = random.Random(9)
    texts = ["".join(chance.choices(ALPHABET, k=chance.randint(0, 30))) for _ in range(3_000)]
    texts += ["", " ", "a" * 5_000, "x <|endoftext|> y", "it's we'll'S"]
    found = P.TextIds(BYTE_TOKENIZER)
    for at in range(0, len(texts), 50):
        some = texts[at:at + 50]
        for text, ids in zip(some, found.of(some)):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, text


def test_remembered_words_are_bounded(monkeypatch, tokenizer):
    monkeypatch.setattr(P, "_REMEMBERED", 5)
    found = P.TextIds(BYTE_TOKENIZER)
    for text in ("one two three four", "five six", "one two three four seven eight"):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(found.of([text])[0], "<u4").tolist() == want
        assert len(found.known) <= 8


def check_whole(docs, rows, capacity, tokenizer):
    """Every id in exactly one piece, sequences gapless and within the capacity."""
    want = Counter()
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [P.END]
        rest = (len(ids) - 1) % capacity + 1
        ends = list(range(rest, len(ids) + 1, capacity))
        for piece, (start, end) in enumerate(zip([0, *ends], ends)):
            crc = zlib.crc32(np.array(ids[start:end], "<u4").tobytes())
            want[doc_id, piece, start, end - start, crc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_of_odd_documents(spark, tokenizer):
    chance = random.Random(2)
    docs = [(i, "".join(chance.choices(ALPHABET, k=chance.randint(0, 60)))) for i in range(200)]
    docs += [(None, "no id"), (None, "no id"), (5, None), (5, ""), (6, "word " * 900), (7, "same")] + [(7, "same")] * 80
    rows_in = [(i, t, "x", 1, 2) for i, t in docs]
    table = spark.createDataFrame(rows_in, "doc_id long, text string, task string, place int, length int")
    rows = P.pack_few(table.repartition(7), BYTE_TOKENIZER, capacity=64).collect()
    n = check_whole(docs, rows, 64, tokenizer)
    total = sum(r.length for r in rows)
    assert n <= 1.05 * total / 64 + 2


def test_empty_table(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack_few(table, BYTE_TOKENIZER).collect() == []

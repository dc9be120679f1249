"""Toxicity by a subsequence-kernel support vector machine with Nystroem landmarks.

The string kernel compares words by their three-letter subsequences inside five letters,
a gap costing half the weight, so that stems, gapped spellings and inserted characters
stay close. Landmarks are words of the training sentences; a word's features are its
kernel values with them, whitened by the landmarks' own kernel matrix, and a linear
support vector machine separates them. A sentence scores as its strongest word, a
document as its strongest sentence.

Labels are of documents. Sentences of clean documents are clean. Of a toxic document the
sentences with its witnesses, the words most telling of toxic documents, are toxic; its
other sentences stay unlabelled, and the fitted machine adds its own witness.

As the kernel is an inner product of subsequence weights, the landmark expansion is one
weight per subsequence, and a word costs one sum at scoring time.

Whole texts count; words over ``PIECE`` letters are read in overlapping pieces. Texts
without letters, null and empty ones score as a text without any telling word. Without
toxic or without clean training documents every score is the share of toxic ones.
"""

from __future__ import annotations

import re
import sys
import types
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from stratamart.llm.common import emit
from stratamart.llm.labelled import labelled_sample

# Bounds of the training sample: documents of either label, distinct sentences' words of
# one document (by smallest hash), clean words the machine is fitted on.
PER_CLASS = 1_500
WORDS_A_DOCUMENT = 3_000
CLEAN_WORDS = 12_000
LANDMARKS = 128
SPAN, DECAY = 5, 0.5
PIECE, OVERLAP = 40, 8
_CACHE = 700_000
_TOGETHER = 10_000  # words whose subsequences are held at a time
CODES = 64
OFFSETS = [(0, *c) for c in combinations(range(1, SPAN), 2)]
_OTHER = re.compile(r"[\W_]+")
# Digits and signs that stand for letters.
_LOOKS = str.maketrans("013457@$", "oieastas")
_SPACED = re.compile(r"(?<![^\s])(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?![^\s])")


@dataclass
class Model:
    weights: np.ndarray  # one for each subsequence
    bias: float
    slope: float
    shift: float
    machine: bool


def units(word: str) -> list[str]:
    """A word as the kernel reads it: letters only, long words in pieces."""
    word = word.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~").lower()
    if not word.isalpha():
        word = _OTHER.sub("", word.translate(_LOOKS))
    if len(word) <= PIECE:
        return [word] if len(word) >= 3 else []
    return [word[i:i + PIECE] for i in range(0, len(word) - OVERLAP, PIECE - OVERLAP)]


def words_of(text: str | None) -> set[str]:
    """Distinct words of a text; letters set apart by blanks or signs count as a word too."""
    found = (text or "").split()
    out = set(found)
    if sum(len(w) < 3 for w in found) > 3:
        out.update(re.sub(r"[ .*_-]", "", m) for m in _SPACED.findall(text))
    return out


def sentences(text: str | None) -> list[str]:
    return [s for s in re.split(r"[.!?\n]+", text or "") if s.strip()]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, subsequence, weight) of words, weights of one length 1 a word."""
    by_length = defaultdict(list)
    for i, w in enumerate(words):
        by_length[len(w) + 1].append(i)
    parts = []
    for length, mine in by_length.items():
        letters = np.frombuffer("".join("^" + words[i] for i in mine).encode("utf-32-le"), np.uint32)
        letters = letters.reshape(len(mine), length).astype(np.int64)
        plain = (letters >= 97) & (letters < 123)
        code = np.where(plain, letters - 96, np.where(letters == 94, 0, 27 + letters % 37))
        for a, b, c in OFFSETS:
            if c >= length:
                continue
            n = length - c
            ids = (code[:, a:a + n] * CODES + code[:, b:b + n]) * CODES + code[:, c:c + n]
            parts.append((np.repeat(mine, n), ids.ravel(), np.full(ids.size, DECAY ** (c - 2))))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    word, ids, weight = (np.concatenate(p) for p in zip(*parts))
    key = word * CODES**3 + ids
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    weight = np.add.reduceat(weight, first)
    word, ids = np.divmod(key[first], CODES**3)
    norm = np.sqrt(np.bincount(word, weight**2, minlength=len(words)))
    return word, ids, weight / norm[word]


def decisions(weights: np.ndarray, bias: float, words: list[str]) -> np.ndarray:
    out = np.full(len(words), bias)
    for start in range(0, len(words), _TOGETHER):
        part = words[start:start + _TOGETHER]
        word, ids, weight = subsequences(part)
        out[start:start + len(part)] += np.bincount(word, weight * weights[ids], minlength=len(part))
    return out


def _kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    word, ids, weight = subsequences(landmarks)
    used, at = np.unique(ids, return_inverse=True)
    table = np.zeros((len(used), len(landmarks)), np.float32)
    table[at, word] = weight
    place = np.full(CODES**3, -1, np.int32)
    place[used] = np.arange(len(used))
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for start in range(0, len(words), _TOGETHER):
        _add_kernel(out[start:start + _TOGETHER], words[start:start + _TOGETHER], table, place)
    return out


def _add_kernel(out: np.ndarray, words: list[str], table: np.ndarray, place: np.ndarray) -> None:
    word, ids, weight = subsequences(words)
    known = place[ids] >= 0
    word, at, weight = word[known], place[ids[known]], weight[known]
    for start in range(0, len(word), 50_000):
        part = slice(start, start + 50_000)
        np.add.at(out, word[part], table[at[part]] * weight[part, None].astype(np.float32))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 16) -> tuple[np.ndarray, float]:
    """Linear machine by dual coordinate descent; the bias is a constant feature."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    norms, alpha, w = (x * x).sum(axis=1), np.zeros(len(x)), np.zeros(x.shape[1])
    draw = np.random.default_rng(5)
    active = np.arange(len(x))
    for turn in range(rounds):
        moved = []
        for i in draw.permutation(active):
            slope = y[i] * (x[i] @ w) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
                moved.append(i)
            elif alpha[i]:
                moved.append(i)
        # Words that stay outside the margin are looked at again every fifth round.
        active = np.arange(len(x)) if turn % 5 == 4 else np.array(moved, int)
        if not len(active):
            break
    return w[:-1], float(w[-1])


def fit(documents: list[tuple[list[str], int]]) -> Model:
    """Fit on documents given as (units, toxic)."""
    base = float(np.mean([y for _, y in documents])) if documents else 0.0
    toxic = [u for u, y in documents if y and u]
    clean = [u for u, y in documents if not y and u]
    flat = Model(np.zeros(1, np.float32), 0.0, 0.0, base, False)
    if not toxic or not clean:
        return flat
    in_toxic, in_clean = Counter(w for u in toxic for w in u), Counter(w for u in clean for w in u)
    rate = len(toxic) / len(clean)

    # Copies of a toxic document share all their rare words. A word tells of toxicity by
    # the different documents that hold it: those whose least rare word differs.
    apart = defaultdict(set)
    for u in toxic:
        least = min(xxhash.xxh3_64_intdigest(w) for w in [w for w in u if not in_clean[w]] or u)
        for w in u:
            if in_toxic[w] > 1:
                apart[w].add(least)

    def telling(word: str) -> tuple:
        return (len(apart.get(word, (0,))) + 0.1) / (in_clean[word] * rate + 0.5), word

    def chosen(words: list[str]) -> list[str]:
        value = {w: telling(w)[0] for w in words}
        best = max(value.values())
        return [w for w in words if value[w] == best or value[w] >= 0.3 * best and len(apart.get(w, ())) >= 3]

    witnesses = Counter(w for u in toxic for w in chosen(u))
    everyday = [w for w, _ in in_clean.most_common(2_000)]
    rest = sorted(set(in_clean) - set(everyday), key=lambda w: xxhash.xxh3_64_intdigest(w))
    negatives = (everyday + rest)[:CLEAN_WORDS]
    all_clean = sorted(in_clean)
    model = flat
    for _ in range(3):
        heads = [w for w, _ in witnesses.most_common(LANDMARKS // 2)]
        landmarks = sorted({*heads, *negatives[:: max(1, len(negatives) // (LANDMARKS // 2))]})
        own = _kernel(landmarks, landmarks).astype(np.float64)
        values, axes = np.linalg.eigh(own + 1e-6 * np.eye(len(own)))
        whiten = axes / np.sqrt(np.maximum(values, 1e-6))
        positives = sorted(witnesses)
        words = positives + negatives
        y = np.array([1.0] * len(positives) + [-1.0] * len(negatives))
        times = np.array([witnesses[w] for w in positives], float)
        cost = np.r_[10 * np.minimum(times, 20), np.full(len(negatives), 10.0)]
        w, bias = _svm(_kernel(words, landmarks) @ whiten, y, cost)
        word, ids, weight = subsequences(landmarks)
        table = np.zeros(CODES**3)
        np.add.at(table, ids, weight * (whiten @ w)[word])
        # Clean words on the wrong side join the training words.
        f = decisions(table, bias, all_clean)
        wrong = [all_clean[i] for i in np.flatnonzero(f > -0.5)]
        negatives = list(dict.fromkeys([*wrong, *negatives]))[: 2 * CLEAN_WORDS]
        value = dict(zip(vocabulary := sorted(in_toxic), decisions(table, bias, vocabulary)))
        witnesses = Counter(w for u in toxic for w in {*chosen(u), max(u, key=lambda x: (value[x], x))})
        strongest = np.array([max(value[x] for x in u) for u in toxic])
        of_clean = dict(zip(all_clean, f))
        weakest = np.array([max(of_clean[x] for x in u) for u in clean])
        # The score is one half where the two kinds of documents part best, as near to
        # the machine's own boundary as may be.
        cuts = np.unique(np.r_[strongest, weakest, 0.0])
        cuts = (cuts[1:] + cuts[:-1]) / 2
        errors = [(strongest < c).mean() + (weakest >= c).mean() + abs(c) / 20 for c in cuts]
        cut = cuts[int(np.argmin(errors))] if len(cuts) else 0.0
        model = Model(table.astype(np.float32), bias, 4.0, float(cut), True)
        if not wrong:
            break
    return model


def _training_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for text, y in zip(*(c.to_pylist() for c in batch.columns)):
                found = {u for s in sentences(text) for w in words_of(s) for u in units(w)}
                if len(found) > WORDS_A_DOCUMENT:
                    found = sorted(found, key=lambda u: xxhash.xxh3_64_intdigest(u))[:WORDS_A_DOCUMENT]
                yield " ".join(found), y

    return emit({"units": pa.string(), "y": pa.int32()}, rows(), 256)


def fit_toxicity(docs: DataFrame, labels: DataFrame, allowed: Column, per_class: int = PER_CLASS) -> Model:
    """Fit on at most ``2 * per_class`` labelled documents of those ``allowed``."""
    sample = labelled_sample(docs, labels, "toxic", allowed, per_class)
    rows = sample.select("text", "y").mapInArrow(_training_units, "units string, y int").collect()
    pool: dict[str, str] = {}  # one string for a word, however many documents have it
    documents = [(sorted(pool.setdefault(u, u) for u in r["units"].split()), r["y"]) for r in rows]
    del rows
    return fit(sorted(documents))


class _Strength(dict):
    """Decision value of raw words, remembered by the Python worker."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def add(self, words: set[str]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > _CACHE:
            self.clear()
            new = list(words)
        pieces = [(w, u) for w in new for u in units(w)]
        distinct = list(dict.fromkeys(u for _, u in pieces))
        value = dict(zip(distinct, decisions(self.model.weights, self.model.bias, distinct).tolist()))
        self.update(dict.fromkeys(new, self.model.bias))
        for w, u in pieces:
            if value[u] > self[w]:
                self[w] = value[u]


def document_scores(model: Model, texts: list[str | None], strength: _Strength) -> np.ndarray:
    if not model.machine:
        return np.full(len(texts), model.shift)
    words = [words_of(t) for t in texts]
    strength.add(set().union(*words))
    strongest = np.array([max(map(strength.__getitem__, w), default=model.bias) for w in words])
    return 1 / (1 + np.exp(-np.clip(model.slope * (strongest - model.shift), -50, 50)))


def toxicity_score(model: Model, spark) -> object:
    """A column function of the text: score from 0 to 1."""
    shared = spark.sparkContext.broadcast(vars(model))  # plain values: a broadcast names its classes
    mark = xxhash.xxh3_64_intdigest(model.weights.tobytes() + repr((model.bias, model.shift)).encode())

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = sys.modules.setdefault("_stratamart_worker", types.ModuleType("_stratamart_worker"))
        if getattr(held, "strength_of", None) != mark:
            held.strength, held.strength_of = _Strength(Model(**shared.value)), mark
        for texts in batches:
            out = [
                document_scores(held.strength.model, list(texts.iloc[at:at + 64]), held.strength)
                for at in range(0, len(texts), 64)
            ]
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return score

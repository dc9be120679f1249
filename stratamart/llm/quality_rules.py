"""Quality rules by distribution divergence from language references.

A language's references are two histograms over all its documents: character classes, and
its most frequent words with one bin for all other words. A document is compared with its
own language's references, or, where it has none, with the nearest ones, by Jensen-Shannon
distance (base 2, 0 to 1). A text without any common word is as far from the word reference as
any can be; the limit is a share of that distance. Guards: documents under ``LEAST_WORDS`` words are not judged by
words, as short texts diverge by chance, and the expected chance divergence is taken off.

Base rules stand before that: too few words, or too many words in repeated three-word
windows. A null or empty text has no words and fails them. Null languages are judged by the
nearest reference. Other columns and repeated rows pass through.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import emit, stage

COMMON_WORDS = 48
# Languages with references: those with the most words, at most so many.
MOST_LANGUAGES = 256
LEAST_WORDS = 100
CLASS_LIMIT = 0.30
# Words are too far from a reference at this share of the distance of a text without any of
# the language's common words, where these make up at least ``COMMON_SHARE`` of the language.
WORD_SHARE, COMMON_SHARE = 0.65, 0.10
FEWEST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = "#*$%&|<>"
CLASSES = ("continuation", "space", "lower", "upper", "digit", "symbol", "punctuation", "other", "control")
_FLUSH = 400_000


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("punctuation"), np.int64)
    for name, codes in (
        ("control", [*range(32), 127]), ("space", [32, *range(9, 14)]), ("lower", range(97, 123)),
        ("upper", range(65, 91)), ("digit", range(48, 58)), ("symbol", map(ord, SYMBOLS)),
        ("continuation", range(128, 192)), ("other", range(192, 256)),
    ):
        table[list(codes)] = CLASSES.index(name)
    return table


def class_counts(raw: bytes, table: np.ndarray) -> np.ndarray:
    return np.bincount(table[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES))


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = np.zeros(len(words), bool)
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered[i:i + 3] = True
    return int(covered.sum())


def base_metrics(raw: bytes, words: list[bytes], classes: np.ndarray) -> tuple:
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    points = int(classes[1:].sum())  # code points: bytes that continue none
    return (
        len(words), points - int(classes[1]), int(classes[CLASSES.index("symbol")]),
        len(lines) - len(set(lines)), repeated_words(words))


def _distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon divergence of two histograms, base 2; 1 where one is empty."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(max(0.0, parts.sum() / 2))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word or null, class number or null, n) of a task."""
    table = _class_table()

    def rows():
        words: dict[str | None, Counter] = defaultdict(Counter)
        classes: dict[str | None, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))

        def flush():
            for lang, counts in words.items():
                for word, n in counts.items():
                    yield lang, word, None, n
            words.clear()

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = (text or "").encode()
                words[lang].update(raw.lower().split())
                classes[lang] += class_counts(raw, table)
                if sum(map(len, words.values())) > _FLUSH:
                    yield from flush()
        yield from flush()
        for lang, counts in classes.items():
            for k, n in enumerate(counts.tolist()):
                yield lang, None, k, n

    kinds = {"lang": pa.string(), "word": pa.binary(), "class": pa.int32(), "n": pa.int64()}
    return emit(kinds, rows())


def references(docs: DataFrame) -> dict[str, tuple[dict[bytes, int], np.ndarray, np.ndarray]]:
    """Language: places of its common words, word and class histograms, limit of words.

    Counts cover all documents; what comes to the driver is at most ``MOST_LANGUAGES``
    languages of ``COMMON_WORDS`` words and one row a class.
    """
    counted = stage(
        docs.select(F.col("lang").cast("string").alias("lang"), "text").where("lang IS NOT NULL")
        .mapInArrow(_word_counts, "lang string, word binary, class int, n long")
        .groupBy("lang", "word", "class").agg(F.sum("n").alias("n")), "language-counts")
    totals = (
        counted.where("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("total"))
        .orderBy(F.desc("total"), "lang").limit(MOST_LANGUAGES).collect())
    kept = {r["lang"]: r["total"] for r in totals}
    chosen = counted.where(F.col("lang").isin(list(kept)))
    window = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = chosen.where("word IS NOT NULL").withColumn("_r", F.row_number().over(window)).where(
        F.col("_r") <= COMMON_WORDS)
    words: dict[str, list] = defaultdict(list)
    for r in sorted(common.collect(), key=lambda r: (r["lang"], r["_r"])):
        words[r["lang"]].append((bytes(r["word"]), r["n"]))
    classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES)))
    for r in chosen.where("word IS NULL").collect():
        classes[r["lang"]][r["class"]] += r["n"]
    out = {}
    for lang, total in sorted(kept.items()):
        held = words[lang]
        histogram = np.array([n for _, n in held] + [total - sum(n for _, n in held)], float)
        out[lang] = ({w: i for i, (w, _) in enumerate(held)}, histogram, classes[lang][1:], word_limit(histogram))
    return out


def word_limit(histogram: np.ndarray) -> float:
    """Longest word distance that passes; the last bin is that of all other words."""
    if histogram[:-1].sum() < COMMON_SHARE * histogram.sum():
        return 1.0
    none = np.zeros(len(histogram))
    none[-1] = 1
    return WORD_SHARE * _distance(none, histogram) ** 0.5


def divergence(words: list[bytes], classes: np.ndarray, reference) -> tuple[float, float]:
    """Distances from a reference: of character classes, and of words less chance."""
    places, histogram, reference_classes, _ = reference
    own = np.zeros(len(histogram))
    for word in words:
        own[places.get(word, -1)] += 1
    chance = (len(own) - 1) / (8 * np.log(2) * max(1, len(words)))
    return _distance(classes[1:], reference_classes) ** 0.5, max(0.0, _distance(own, histogram) - chance) ** 0.5


def judged(refs: dict, lang: str | None, text: str | None, table: np.ndarray) -> tuple:
    raw = (text or "").encode()
    words = raw.split()
    classes = class_counts(raw, table)
    metrics = base_metrics(raw, words, classes)
    n, repeated = metrics[0], metrics[4]
    failed = n < FEWEST_WORDS or 100 * repeated > MOST_REPEATED * n
    far, limit = (0.0, 0.0), 1.0
    if n and refs:
        lowered = raw.lower().split()
        own = refs.get(lang)
        near = [own] if own else refs.values()
        far, limit = min(((divergence(lowered, classes, r), r[3]) for r in near), key=lambda x: sum(x[0]))
    kept = not failed and far[0] <= CLASS_LIMIT and (n < LEAST_WORDS or far[1] <= limit)
    return (*metrics, failed, kept, *far)


JUDGED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double")


def apply_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with the fields of ``JUDGED`` in a struct ``_judged``."""
    shared = docs.sparkSession.sparkContext.broadcast(references(docs))
    names = [c.split()[0] for c in JUDGED.split(", ")]

    @F.pandas_udf(JUDGED)
    def rules(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        refs, table = shared.value, _class_table()
        for langs, texts in batches:
            yield pd.DataFrame(
                [judged(refs, g, t, table) for g, t in zip(langs, texts)], columns=names)

    return docs.withColumn("_judged", rules(F.col("lang").cast("string"), "text"))

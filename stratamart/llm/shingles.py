"""Word shingles of whole texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
# Odd multipliers, one for each place in a shingle, and the mark of a short text.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                    0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_CACHE = 400_000


class WordHashes(dict):
    """Hash of a word, remembered; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, cache: WordHashes, words: int = WORDS) -> np.ndarray:
    """Distinct shingles of A-Z-lowered words; a shorter text is one shingle as a whole."""
    found = (text or "").encode().lower().split()  # bytes: ASCII space and A-Z only
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))], np.uint64)
    hashes = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    n = len(found) - words + 1
    mixed = np.zeros(n, np.uint64)
    for place in range(words):
        mixed += hashes[place:place + n] * _PLACES[place % len(_PLACES)]
        if words > len(_PLACES):
            mixed = (mixed << np.uint64(7)) | (mixed >> np.uint64(57))
    return np.unique(mixed)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    return len(np.intersect1d(a, b, assume_unique=True))

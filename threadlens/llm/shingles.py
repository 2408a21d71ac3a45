"""Word-shingle sets as arrays of 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


class WordHashes:
    """word -> 64-bit hash.  Nothing is remembered: hashing a word takes less
    time than finding it in a cache of all words, and no memory."""

    __getitem__ = staticmethod(xxhash.xxh3_64_intdigest)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased: ``bytes`` methods touch ASCII only, and
    ``split`` cuts at exactly the six blanks of the word definition."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The distinct 5-word shingles of a whole text as sorted int64 hashes.
    Fewer than five words: the whole sequence as one; no words: empty."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.int64)
    if len(words) < SHINGLE_WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64).view(np.int64)
    a = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(a) - SHINGLE_WORDS + 1
    mixed = a[:n] * _ODD[0]
    for i in range(1, SHINGLE_WORDS):
        mixed = _mix(mixed) + a[i:i + n] * _ODD[i]
    return np.unique(_mix(mixed).view(np.int64))

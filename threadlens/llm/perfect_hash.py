"""Minimal perfect hashing of integer keys, in numpy.

Keys are dealt into ``BUCKETS`` buckets by a mixed hash.  A bucket's function is
a row of bit levels: at each level every remaining key hashes to a bit, keys
that are alone on theirs set it, the others go on to the next level.  A key's
number is the count of bits set before its own, so n keys get the numbers 0 to
n - 1 and cost a few bits each.  Other keys get any number or none, so whoever
looks up must compare the key stored there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BUCKETS = 256
SPARE = 1.6  # bits of a level per key that reaches it
MOST_LEVELS = 64
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit keys, another one for every level."""
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64) + np.uint64(level + 1) * _STEP
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, -1) >> np.uint64(56)).astype(np.int64)


def _bit(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    return ((mixed(keys, level) >> np.uint64(32)) * np.asarray(size, np.uint64) >> np.uint64(32)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(level sizes in bits, the levels' bits as 64-bit words) of one bucket's
    distinct keys.  Sizes are whole words."""
    sizes, words, left, level = [], [], np.unique(keys), 0
    while len(left):
        if level == MOST_LEVELS:
            raise ValueError(f"{len(left)} keys found no bit in {level} levels")
        size = 64 * max(1, int(np.ceil(SPARE * len(left) / 64)))
        at = _bit(left, level, size)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(size)
        left, level = left[~alone[at]], level + 1
    return np.array(sizes, np.int64), np.concatenate(words) if words else np.empty(0, np.uint64)


@dataclass(frozen=True)
class PerfectHash:
    """The functions of several buckets side by side: a key's number is
    counted over all of them."""

    starts: np.ndarray  # (BUCKETS, levels): first bit of a bucket's level
    sizes: np.ndarray   # (BUCKETS, levels): its bits, 0 where there is none
    words: np.ndarray   # all bits
    before: np.ndarray  # bits set before each word

    @classmethod
    def of(cls, built: dict[int, tuple[np.ndarray, np.ndarray]]) -> PerfectHash:
        levels = max([1, *(len(s) for s, _ in built.values())])
        starts, sizes = np.zeros((BUCKETS, levels), np.int64), np.zeros((BUCKETS, levels), np.int64)
        at, words = 0, [np.empty(0, np.uint64)]
        for bucket in sorted(built):
            own, bits = built[bucket]
            starts[bucket, :len(own)] = at + np.cumsum(own) - own
            sizes[bucket, :len(own)] = own
            at += int(own.sum())
            words.append(bits)
        words = np.concatenate(words)
        counts = np.bitwise_count(words).astype(np.int64)
        return cls(starts, sizes, words, np.cumsum(counts) - counts)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 where no level has a bit for it."""
        out = np.full(len(keys), -1, np.int64)
        where, bucket = np.arange(len(keys)), bucket_of(keys)
        for level in range(self.sizes.shape[1]):
            size = self.sizes[bucket, level]
            there = size > 0
            where, keys, bucket, size = where[there], keys[there], bucket[there], size[there]
            if not len(where):
                break
            bit = self.starts[bucket, level] + _bit(keys, level, size)
            word, shift = bit >> 6, (bit & 63).astype(np.uint64)
            hit = (self.words[word] >> shift) & np.uint64(1) == 1
            lower = self.words[word[hit]] & ((np.uint64(1) << shift[hit]) - np.uint64(1))
            out[where[hit]] = self.before[word[hit]] + np.bitwise_count(lower)
            where, keys, bucket = where[~hit], keys[~hit], bucket[~hit]
        return out

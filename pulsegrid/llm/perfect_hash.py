"""Minimal perfect hashing of integer keys, built bucket by bucket.

A bucket's keys set bits of a table twice their number; keys alone on their
bit stay, the others go to the next, smaller table. A key's index is the
number of bits set before its own over all tables, so ``n`` keys get the
numbers 0 to n - 1 in about 4 bits a key. The few keys left after the last
table are listed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from pulsegrid.llm.common import mix

BUCKETS = 256
LEVELS = 24
_GOLD = 0x9E3779B97F4A7C15


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys * np.uint64(_GOLD) + np.uint64(1)) >> np.uint64(56)).astype(np.int64)


def _slot(keys: np.ndarray, level: int, size) -> np.ndarray:
    return (mix(keys + np.uint64((level + 2) * _GOLD % (1 << 64))) % size).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(one byte array of bits a level, keys left over) for the distinct keys of a bucket."""
    levels: list[np.ndarray] = []
    while len(keys) and len(levels) < LEVELS:
        size = -(-2 * len(keys) // 64) * 64
        at = _slot(keys, len(levels), np.uint64(size))
        alone = np.bincount(at, minlength=size) == 1
        levels.append(np.packbits(alone, bitorder="little"))
        keys = keys[~alone[at]]
    return levels, np.sort(keys)


@dataclass
class PerfectHash:
    """All buckets as one bit string (64-bit words), level after level."""

    words: np.ndarray
    before: np.ndarray  # bits set before each word
    starts: np.ndarray  # [level, bucket] first bit
    sizes: np.ndarray  # [level, bucket] bits
    left: np.ndarray  # sorted keys without a bit

    @classmethod
    def of(cls, buckets: dict[int, tuple[list[bytes], np.ndarray]]) -> PerfectHash:
        starts, sizes = np.zeros((LEVELS, BUCKETS), np.int64), np.zeros((LEVELS, BUCKETS), np.int64)
        parts, at = [], 0
        for level in range(LEVELS):
            for b, (levels, _) in sorted(buckets.items()):
                if level < len(levels):
                    starts[level, b], sizes[level, b] = at, 8 * len(levels[level])
                    parts.append(np.frombuffer(levels[level], np.uint64))
                    at += sizes[level, b]
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
        left = np.sort(np.concatenate([x for _, x in buckets.values()])) if buckets else np.zeros(0, np.uint64)
        return cls(words, np.concatenate([[0], ones]).astype(np.int64), starts, sizes, left)

    def __len__(self) -> int:
        return int(self.before[-1]) + len(self.left)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The number of every key; any number or -1 for keys that were not in the set."""
        out = np.full(len(keys), -1, np.int64)
        todo, buckets = np.arange(len(keys)), bucket_of(keys)
        for level in range(LEVELS):
            size = self.sizes[level, buckets[todo]]
            todo = todo[size > 0]
            if not len(todo):
                break
            b = buckets[todo]
            at = self.starts[level, b] + _slot(keys[todo], level, self.sizes[level, b].astype(np.uint64))
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) > 0
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found = self.before[word] + np.bitwise_count(below)
            out[todo[hit]] = found[hit]
            todo = todo[~hit]
        if len(self.left):
            rest = np.flatnonzero(out < 0)
            at = np.minimum(np.searchsorted(self.left, keys[rest]), len(self.left) - 1)
            hit = self.left[at] == keys[rest]
            out[rest[hit]] = self.before[-1] + at[hit]
        return out

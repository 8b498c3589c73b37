"""Minimal perfect hash over 128-bit key digests, by levels of bit arrays.

Keys that are alone at their bit of a level stay there, the others go on to the
next level; a key's number is the rank of its bit. Lookups of keys outside the
set give some number or -1, so a stored fingerprint has to confirm them.
"""

from __future__ import annotations

import numpy as np

BITS_PER_KEY = 2
MOST_LEVELS = 200


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def fingerprint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a ^ _mix(b))


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mix(a + np.uint64(level + 1) * (b | np.uint64(1))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self.begins = np.concatenate([[0], np.cumsum(sizes)])

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        """Numbers distinct keys from 0 without a gap."""
        sizes, levels = [], []
        while a.size:
            if len(sizes) >= MOST_LEVELS:
                raise ValueError("two keys share a digest")
            size = -(-BITS_PER_KEY * a.size // 64) * 64
            at = _place(a, b, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = ~alone[at]
            a, b = a[left], b[left]
        words = np.concatenate(levels) if levels else np.empty(0, "<u8")
        return cls(np.array(sizes, np.int64), words)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = np.full(a.size, -1, np.int64)
        left = np.arange(a.size)
        for level, size in enumerate(self.sizes):
            if not left.size:
                break
            at = _place(a[left], b[left], level, int(size)) + self.begins[level]
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[hit]] = (self.ranks[at >> 6] + below)[hit]
            left = left[~hit]
        return found

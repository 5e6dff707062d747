"""A minimal perfect hash of 128-bit keys in flat numpy arrays.

Level by level, each key that is left takes the place that the level's hash
gives it; a place that one key alone takes is kept, the others go to the
next level. The slot of a key is the number of kept places before its own,
so n keys have the slots 0 to n - 1. The table keeps the key of every slot:
a lookup is checked against it, so a key that was never put in is told
apart from one that hashes to its slot.
"""

from __future__ import annotations

import numpy as np

from topicframe.llm.spans import mix

#: Places a key on each level.
ROOM = 1.6
_BLOCK = 64


class PerfectHash:
    """Slots of distinct keys (two uint64 arrays)."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.n = len(k1)
        self.sizes: list[int] = []
        taken: list[np.ndarray] = []
        left = np.arange(self.n)
        while len(left):
            size = max(_BLOCK, int(len(left) * ROOM))
            at = self._place(k1[left], k2[left], len(self.sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            kept = alone[at]
            if not kept.any() and len(self.sizes) > 64:
                raise ValueError("keys of a perfect hash must be distinct")
            self.sizes.append(size)
            taken.append(alone)
            left = left[~kept]
        bits = np.concatenate(taken) if taken else np.zeros(0, bool)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.bits = bits
        self.before = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)  # kept places before each place
        self.key1, self.key2 = np.zeros(self.n, np.uint64), np.zeros(self.n, np.uint64)
        slot = self._slots(k1, k2)
        if self.n and np.bincount(slot, minlength=self.n).max() != 1:
            raise ValueError("two keys have one slot")
        self.key1[slot], self.key2[slot] = k1, k2

    @staticmethod
    def _place(k1: np.ndarray, k2: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        return (mix(k1 ^ mix(k2 + salt)) % np.uint64(size)).astype(np.int64)

    def _slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """A slot for every key, right for those of the table; others may get -1 or a slot of another key."""
        out = np.full(len(k1), -1, np.int64)
        left = np.arange(len(k1))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + self._place(k1[left], k2[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.before[at[hit]]
            left = left[~hit]
        return out

    def slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not in the table."""
        out = self._slots(k1, k2)
        some = np.flatnonzero(out >= 0)
        wrong = (self.key1[out[some]] != k1[some]) | (self.key2[out[some]] != k2[some])
        out[some[wrong]] = -1
        return out

"""Minimal perfect hash of 64-bit keys in numpy, with the keys stored by slot.

Keys are tried level by level in a bit array of twice their number; those alone at their bit stay, the
others go on to the next level. A key's slot is the number of bits set before its own, so n keys have the
slots 0 to n - 1. Any other key may meet a set bit, too: the key stored at the slot tells.
"""

from __future__ import annotations

import pickle

import numpy as np


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = (keys ^ np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(29))) >> np.uint64(1)) % np.uint64(size)


class PerfectHash:
    def __init__(self, levels: list[tuple[int, np.ndarray, np.ndarray]], keys: np.ndarray):
        self.levels, self.keys = levels, keys  # of each level: size, words of bits, slot of each word's first bit

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys: distinct uint64."""
        left, levels, base = np.asarray(keys, np.uint64), [], 0
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            at = _places(left, len(levels), size)
            alone = np.bincount(at.astype(np.int64), minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            words = np.packbits(bits, bitorder="little").view(np.uint64)
            ranks = base + np.append(0, np.cumsum(np.bitwise_count(words).astype(np.int64))[:-1])
            levels.append((size, words, ranks))
            base += int(alone.sum())
            left = left[~alone]
        found = cls(levels, np.zeros(base, np.uint64))
        own = np.asarray(keys, np.uint64)
        found.keys[found._slots(own)] = own
        return found

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, words, ranks) in enumerate(self.levels):
            at = _places(keys[open_], level, size)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            own = words[word]
            hit = (own >> bit) & np.uint64(1) == 1
            below = own[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = ranks[word[hit]] + np.bitwise_count(below)
            open_ = open_[~hit]
            if not len(open_):
                break
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for what is none of the keys."""
        slots = self._slots(keys)
        if len(self.keys):
            slots[self.keys[np.maximum(slots, 0)] != keys] = -1
        return slots

    def to_bytes(self) -> bytes:
        return pickle.dumps((self.levels, self.keys))

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        return cls(*pickle.loads(data))

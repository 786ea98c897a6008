"""Minimal perfect hashes over 64-bit keys, in numpy: levels of bit arrays in which a key that is alone at its place stays."""

from __future__ import annotations

import numpy as np

from tradewake.llm.words import mixed

_STEP = 0x9E3779B97F4A7C15


class PerfectHash:
    """Distinct keys -> 0 .. n - 1, each number once. A key that was not built in gets any number, or -1."""

    def __init__(self, keys: np.ndarray | None = None, bits: list[np.ndarray] | None = None):
        self.bits = bits if bits is not None else list(self._levels(keys))
        counts = [np.bitwise_count(b).astype(np.int64) for b in self.bits]
        flat = np.concatenate([np.zeros(0, np.int64), *counts])
        before = np.cumsum(flat) - flat
        self.before = np.split(before, np.cumsum([len(c) for c in counts])[:-1]) if counts else []

    @staticmethod
    def places(keys: np.ndarray, level: int, words: int | np.ndarray) -> np.ndarray:
        """The bit of each key in a level of so many words."""
        return mixed(keys + np.uint64(_STEP * (level + 1) % (1 << 64))) % np.asarray(words * 64).astype(np.uint64)

    def _levels(self, keys: np.ndarray):
        level = 0
        while len(keys):
            words = -(-len(keys) // 32)
            at = self.places(keys, level, words)
            alone = np.bincount(at.astype(np.int64), minlength=words * 64)[at.astype(np.int64)] == 1
            bits = np.zeros(words, np.uint64)
            np.bitwise_or.at(bits, (at[alone] >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at[alone] & np.uint64(63)))
            yield bits
            keys, level = keys[~alone], level + 1

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.bits, self.before)):
            at = self.places(keys[todo], level, len(bits))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (bits[word] >> bit & np.uint64(1)).astype(bool)
            below = bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[todo[hit]] = before[word[hit]] + np.bitwise_count(below).astype(np.int64)
            todo = todo[~hit]
        return out

"""A read-only hash table from 64-bit keys to 32-bit numbers that looks up whole numpy arrays."""

from __future__ import annotations

import numpy as np

EMPTY = np.uint64(2**64 - 1)


class HashTable:
    """Open addressing; a key of 2**64 - 1 cannot be held."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, absent: int):
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.mask, self.absent = (1 << self.bits) - 1, absent
        self.keys, self.values = np.full(self.mask + 1, EMPTY), np.full(self.mask + 1, absent, dtype=np.int32)
        slot, self.steps = self._slot(keys), 0
        while len(keys):  # each turn every free slot takes one of the keys that want it; the others step on
            free = self.keys[slot] == EMPTY
            self.keys[slot[free]] = keys[free]
            self.values[slot[free]] = values[free]
            left = self.keys[slot] != keys
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & self.mask
            self.steps += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        at = self.keys[slot]
        hit = at == keys
        out = np.where(hit, self.values[slot], np.int32(self.absent))
        open_ = np.flatnonzero(~hit & (at != EMPTY))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            at = self.keys[slot]
            hit = at == keys[open_]
            out[open_[hit]] = self.values[slot[hit]]
            more = ~hit & (at != EMPTY)
            open_, slot = open_[more], slot[more]
        return out

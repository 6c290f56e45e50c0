"""An open-addressing hash table over 64-bit keys that is probed for whole arrays."""

from __future__ import annotations

import numpy as np

EMPTY = np.uint64(2**64 - 1)


class HashTable:
    """Distinct keys (not 2^64 - 1) to values; linear probing with at most half of the slots filled."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing):
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, EMPTY, np.uint64)
        self.values = np.full(1 << self.bits, missing, values.dtype)
        self.missing = missing
        at = self._slots(keys)
        while len(keys):  # the keys of one probe distance are placed together, the first comer wins
            free = np.flatnonzero(self.keys[at] == EMPTY)
            _, winners = np.unique(at[free], return_index=True)
            placed = free[winners]
            self.keys[at[placed]], self.values[at[placed]] = keys[placed], values[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, ``missing`` for keys that the table does not hold."""
        at = self._slots(keys)
        held = self.keys[at]
        found = self.values[at]
        pending = np.flatnonzero(held != keys)
        found[pending] = self.missing
        pending = pending[held[pending] != EMPTY]
        while len(pending):
            at[pending] = (at[pending] + 1) & (len(self.keys) - 1)
            held = self.keys[at[pending]]
            hit = held == keys[pending]
            found[pending[hit]] = self.values[at[pending[hit]]]
            pending = pending[~hit & (held != EMPTY)]
        return found

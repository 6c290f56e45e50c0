"""A minimal perfect hash over 128-bit keys, built and probed with numpy.

Levels of bit arrays: a key that is alone on its bit stays there, the others go to the next level. A
key's slot is the number of set bits before its own, so slots are 0..n-1 without gaps. A key outside
the set can land on a slot too; the caller compares the fingerprint stored there.
"""

from __future__ import annotations

import numpy as np

BITS_PER_KEY = 2.0


def _position(place: np.ndarray, check: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = place ^ (check * np.uint64(2 * level + 0x9E3779B97F4A7C15))
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ mixed >> np.uint64(32)) % np.uint64(size)


def build(place: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level sizes in bits and the packed bits of all levels, for distinct ``(place, check)`` pairs."""
    sizes, parts = [], []
    while len(place):
        size = 64 * max(1, int(np.ceil(BITS_PER_KEY * len(place) / 64)))
        at = _position(place, check, len(sizes), size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        sizes.append(size)
        parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
        rest = ~alone[at]
        place, check = place[rest], check[rest]
    bits = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return np.array(sizes, np.int64), bits


def slots(sizes: np.ndarray, bits: np.ndarray, place: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 where no level holds it."""
    before = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))
    found = np.full(len(place), -1, np.int64)
    open_, start = np.arange(len(place)), 0
    for level, size in enumerate(sizes.tolist()):
        at = _position(place[open_], check[open_], level, size) + np.uint64(start)
        word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        hit = (bits[word] >> bit & np.uint64(1)) == 1
        below = bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
        found[open_[hit]] = before[word[hit]] + np.bitwise_count(below)
        open_, start = open_[~hit], start + size
    return found

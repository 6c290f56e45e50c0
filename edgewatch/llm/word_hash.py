"""Words of many texts at once as 64-bit hashes, without a Python loop over words."""

from __future__ import annotations

import numpy as np

#: Word characters are digits, ASCII letters and everything beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: White space between words; everything else belongs to words.
SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[0x20, *range(0x09, 0x0E)]] = True

_LETTERS = np.random.default_rng(20_260_101).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_KEPT_POWERS = 1 << 20
GROUP_BYTES = 1 << 19
_TABLES: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 .. n - 1, modulo 2^64; tables of usual length are kept."""
    if n <= _KEPT_POWERS and base in _TABLES:
        return _TABLES[base][:n]
    size = max(n, _KEPT_POWERS)
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    table = np.multiply.accumulate(factors)
    if size == _KEPT_POWERS:
        _TABLES[base] = table
    return table[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def word_hashes(
    texts: list[bytes], word_bytes: np.ndarray = WORD_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and words per text.

    A word is a run of ``word_bytes`` after A-Z are lower-cased. Its hash is a sum of byte values times
    powers of an odd base, taken from running sums and moved to the word's start, scrambled at the end
    together with its length.
    """
    parts, group, held = [], [], 0
    for text in texts:
        if group and held + len(text) > GROUP_BYTES:
            parts.append(_hash_group(group, word_bytes))
            group, held = [], 0
        group.append(text)
        held += len(text) + 1
    if group:
        parts.append(_hash_group(group, word_bytes))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _hash_group(texts: list[bytes], word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b" ".join(t.lower() for t in texts) + b" ", np.uint8)
    return run_hashes(raw, word_bytes[raw], np.cumsum([len(t) + 1 for t in texts]))


def run_hashes(raw: np.ndarray, inside: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of bytes that are ``inside``, and the runs before each of ``ends``' parts end.

    The byte before each end is outside, so no run reaches from one part into the next.
    """
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    first, last = edges[0::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LETTERS[raw] * _powers(_BASE, len(raw)), out=sums[1:])
    moved = (sums[last] - sums[first]) * _powers(_INVERSE, len(raw))[first]
    counts = np.diff(np.searchsorted(first, ends), prepend=0)
    return mixed(moved + (last - first).astype(np.uint64)), counts

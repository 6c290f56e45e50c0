"""Runs of repeated words, found by catchers of squares over blocks of power-of-two length.

Words are appended in order. On level ``k`` every completed block of ``2 ** k`` words, starting at a
multiple of that length, is a catcher: while the next block fills, each appended word completes one
suffix of ``2 ** k`` words that is compared with the catcher's content, by hashes that double from level
to level. Equality at a distance ``p`` (at least one and less than two block lengths) is a possible
period; the equal stretch is extended to both sides as far as it goes. A stretch that is at least ``p``
long holds a square. Squares of one period that touch are one run, which the extension gives at once.

A run whose length is at least three periods equals itself, moved by its period, over two periods, so a
whole block of the level with ``2 ** k <= p < 2 ** (k + 1)`` lies in that stretch: no such run is missed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from edgewatch.llm.rows import column, pieces
from edgewatch.llm.word_hash import SPACE_BYTES, mixed, run_hashes

LEAST_EXPONENT = 3
NO_WORDS = np.empty(0, np.uint64)
RUNS = (
    "n_words long, n_kept long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed binary"
)


class Run(NamedTuple):
    start: int
    length: int
    period: int


class Catchers:
    """The state after all words so far: suffix hashes by level, and the stretches that were caught.

    Words are 64-bit values, equal for equal words. Several texts may follow one another; no comparison
    reaches from one into the next. Memory: eight bytes a word and level.
    """

    def __init__(self):
        self.levels: list[np.ndarray] = [NO_WORDS]
        self.first = np.empty(0, np.int64)  # of each word: the first word of its text
        self.longest = 0
        self.open = np.empty((0, 3), np.int64)
        self.closed: list[np.ndarray] = []

    def append(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Advance by ``words``; rows ``start, length, period`` of the squares that are new or have grown.

        ``first`` has the number, over all appended words, at which each word's text starts.
        """
        was = [len(h) for h in self.levels]
        self.first = np.concatenate((self.first, first))
        self.levels[0] = np.concatenate((self.levels[0], words))
        self.longest = max(self.longest, int((np.arange(was[0], was[0] + len(words)) - first).max(initial=-1)) + 1)
        for level in range(1, max(self.longest // LEAST_EXPONENT, 1).bit_length()):
            if level == len(self.levels):
                self.levels.append(NO_WORDS)
                was.append(0)
            self._complete(level)
        caught = [self._catch(level, was[level]) for level in range(len(self.levels))]
        rows = self._extended(np.unique(np.concatenate((self.open, *caught)), axis=0))
        at_end = rows[:, 1] + rows[:, 2] == len(self.first)
        self.open, done = rows[at_end], rows[~at_end]
        self.closed.append(done)
        squares = rows[rows[:, 1] - rows[:, 0] >= rows[:, 2]]
        return np.stack((squares[:, 0], squares[:, 1] - squares[:, 0] + squares[:, 2], squares[:, 2]), axis=1)

    def _complete(self, level: int) -> None:
        """Hashes of the suffixes of ``2 ** level`` words that the new words complete."""
        below, own, half = self.levels[level - 1], self.levels[level], 1 << level - 1
        start, stop = len(own), len(below) - half
        if stop > start:
            new = mixed(below[start:stop] * np.uint64(0x9E3779B97F4A7C15) + below[start + half : stop + half])
            self.levels[level] = np.concatenate((own, new))

    def _catch(self, level: int, start: int) -> np.ndarray:
        """``left, right, period`` of the equal blocks that new suffixes have shown to this level's catchers."""
        size, hashes = 1 << level, self.levels[level]
        at = np.arange(start, len(hashes))
        inside = at - self.first[start : len(hashes)]
        catcher = at - (inside & size - 1) - size  # the block before the one that is filling
        hit = (inside >= size) & (hashes[start:] == hashes[catcher])
        at, catcher = at[hit], catcher[hit]
        alive = self.first[at] == self.first[at + size - 1]
        at, catcher = at[alive], catcher[alive]
        return np.stack((catcher, catcher + size, at - catcher), axis=1)

    def _extended(self, rows: np.ndarray) -> np.ndarray:
        """Grow ``[left, right)``, which equals itself moved by the period, as far as the text allows."""
        left, right, period = rows.T.copy()
        moving, total = np.arange(len(rows)), len(self.first)
        while len(moving):
            p, was = period[moving], right[moving] - left[moving]
            first = self.first[left[moving]]
            for level in reversed(range(len(self.levels))):
                size, hashes = 1 << level, self.levels[level]
                if not len(hashes):
                    continue
                at = right[moving]
                ok = at + p + size <= total
                at = np.where(ok, at, 0)
                end = np.where(ok, at + p + size - 1, 0)
                ok &= (self.first[end] == first) & (hashes[at] == hashes[np.where(ok, at + p, 0)])
                right[moving] += size * ok
                at = left[moving] - size
                ok = at >= first
                at = np.where(ok, at, 0)
                ok &= hashes[at] == hashes[np.where(ok, at + p, 0)]
                left[moving] -= size * ok
            moving = moving[right[moving] - left[moving] > was]
        return np.stack((left, right, period), axis=1)

    def runs(self) -> np.ndarray:
        """Rows ``start, length, period`` of the maximal runs of three periods or more, by start, then period."""
        rows = np.concatenate((*self.closed, self.open))
        start, length, period = rows[:, 0], rows[:, 1] - rows[:, 0] + rows[:, 2], rows[:, 2]
        runs = np.stack((start, length, period), axis=1)[length >= LEAST_EXPONENT * period]
        runs = np.unique(runs, axis=0)
        # sorted by start, length and period: the first of equal stretches has the smallest period
        again = np.zeros(len(runs), bool)
        again[1:] = (runs[1:, :2] == runs[:-1, :2]).all(axis=1)
        words, out = self.levels[0], []
        for s, n, p in runs[~again].tolist():
            if np.array_equal(words[s : s + n - p], words[s + p : s + n]):  # hashes of blocks may agree by chance
                out.append((s, n, p))
        return np.array(sorted(out, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def word_values(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for every word of every text, and the words of each text."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    return run_hashes(raw, ~SPACE_BYTES[raw], ends)


def find_runs(texts: Sequence[bytes], least_length: int) -> list[list[Run]]:
    """All runs of at least ``least_length`` words and three periods in each text."""
    words, counts = word_values(texts)
    stops = np.cumsum(counts)
    catchers = Catchers()
    catchers.append(words, np.repeat(stops - counts, counts))
    out: list[list[Run]] = [[] for _ in texts]
    for start, length, period in catchers.runs().tolist():
        if length >= least_length:
            owner = int(np.searchsorted(stops, start, side="right"))
            out[owner].append(Run(start - int(stops[owner] - counts[owner]), length, period))
    return out


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run repeats after its first period."""
    kept, at = [], 0
    for start, end in sorted((r.start + r.period, r.start + r.length) for r in runs):
        kept += words[at:start]
        at = max(at, end)
    return kept + words[at:]


def with_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """A tenth of the documents, chosen by id, gets a tail that repeats; the others stay.

    The words from ``a`` on repeat the first ``p`` of them. A null id and a text without words stay.
    """
    mixed_id = crc32(b"%d" % doc_id) if doc_id is not None else 1
    if mixed_id % 10 or not words:
        return words
    g = mixed_id // 10
    a = g % len(words)
    tail = len(words) - a
    p = 1 + tail // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * (tail // p + 1))[:tail]


def collapse_runs(
    docs: DataFrame, least_length: int = 24, edit=None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_kept, runs, collapsed`` for every row of ``docs``.

    Words are what white space (``[\\x20\\x09-\\x0D]``) separates, compared as they are. ``runs`` lists
    ``start, length, period`` of every maximal stretch of at least ``least_length`` words and three of
    its smallest period, by start, then period; ``collapsed`` joins the words outside the repeated parts
    by one space. ``edit(words, doc_id)`` may change the words first. Null, empty and blank texts have no
    words, no runs and an empty ``collapsed``. Repeated rows and ids are rows of their own, a null id
    passes through, other columns are not read.

    A row is worked on alone, in memory proportional to its words times the logarithm of their number.
    """

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            ids = piece["doc_id"].to_pylist()
            split = [(t or b"").split() for t in piece["text"].to_pylist()]
            if edit:
                split = [edit(words, i) for words, i in zip(split, ids, strict=True)]
            joined = [b" ".join(words) for words in split]
            runs = find_runs(joined, least_length)
            kept = [kept_words(w, r) if r else w for w, r in zip(split, runs, strict=True)]
            collapsed = [b" ".join(k) if r else j for k, r, j in zip(kept, runs, joined, strict=True)]
            sizes = ([len(x) for x in rows] for rows in (split, kept))
            listed = [[r._asdict() for r in own] for own in runs]
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in Run._fields]))
            arrays = [piece["doc_id"], *(pa.array(s, pa.int64()) for s in sizes), pa.array(listed, kind)]
            arrays.append(pa.array(collapsed, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_kept", "runs", "collapsed"])

    wanted = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("binary").alias("text")
    )
    return wanted.mapInArrow(collapse, f"doc_id long, {RUNS}")

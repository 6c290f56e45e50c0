"""Byte-level BPE by padded matrices: all pending words of a length bucket merge together.

A word (one match of the splitting pattern) is a row of symbols. In each round every row merges its
leftmost pair of lowest rank; pair ranks come from an open-addressing hash table probed for the whole
matrix at once. Rows without a pair left are taken out, columns beyond the longest row are cut. Words
are encoded once per worker while the memo holds them, texts are then joins of encoded words.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from edgewatch.llm.hash_table import HashTable
from edgewatch.llm.rows import keyed_texts, pieces, strings
from edgewatch.llm.word_split import Splitter

NO_PAIR = np.int32(2**31 - 1)
MEMO_WORDS = 200_000
MATRIX_CELLS = 1 << 18
WIDE = 256
VOCABULARY_BYTES = 64 << 20


class RankTable:
    """Ranks of a vocabulary, with a hash table from symbol pairs to the rank of their union."""

    def __init__(self, content: bytes):
        rows = (line.split() for line in content.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        self.pairs = HashTable(keys, np.fromiter(pairs.values(), np.int32, len(pairs)), NO_PAIR)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair's union, ``NO_PAIR`` where the vocabulary has none."""
        return self.pairs.find(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif word:
                by_width.setdefault(max(4, 1 << (len(word) - 1).bit_length()), []).append(i)
        for width, rows in by_width.items():
            if width > WIDE:
                for i in rows:
                    out[i] = self._merge_long(words[i]).astype("<u4").tobytes()
                continue
            step = max(1, MATRIX_CELLS // width)
            for start in range(0, len(rows), step):
                some = rows[start : start + step]
                for i, ids in zip(some, self._merge_rows([words[i] for i in some], width), strict=True):
                    out[i] = ids
        return out

    def _merge_rows(self, words: list[bytes], width: int) -> list[bytes]:
        lengths = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        symbols = self.first[raw.reshape(len(words), width)]
        symbols[np.arange(width) >= lengths[:, None]] = -1
        ranks = np.full((len(words), width), NO_PAIR, np.int32)
        inside = np.arange(1, width) < lengths[:, None]
        ranks[:, :-1][inside] = self.pair_ranks(symbols[:, :-1][inside], symbols[:, 1:][inside])
        done = [b""] * len(words)
        rows = np.arange(len(words))
        while len(rows):
            spot = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), spot]
            over = best == NO_PAIR
            if over.any():
                for row, ids, size in zip(rows[over], symbols[over], lengths[over], strict=True):
                    done[row] = ids[:size].astype("<u4").tobytes()
                keep = ~over
                width = int(lengths[keep].max(initial=0))
                rows, lengths, spot, best = rows[keep], lengths[keep], spot[keep], best[keep]
                symbols, ranks = symbols[keep, :width], ranks[keep, :width]
                if not len(rows):
                    break
            here = np.arange(len(rows))
            symbols[here, spot] = best
            tail = np.arange(width - 1) > spot[:, None]
            symbols[:, :-1] = np.where(tail, symbols[:, 1:], symbols[:, :-1])
            symbols[:, -1] = -1
            ranks[:, :-1] = np.where(tail, ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NO_PAIR
            lengths -= 1
            self._refresh(symbols, ranks, here, spot, spot + 1 < lengths)
            self._refresh(symbols, ranks, here, spot - 1, spot > 0)
        return done

    def _refresh(self, symbols, ranks, rows, at, valid) -> None:
        """New ranks of the pairs that start at ``at``; a pair past the end has none."""
        ranks[rows[~valid & (at >= 0)], at[~valid & (at >= 0)]] = NO_PAIR
        rows, at = rows[valid], at[valid]
        ranks[rows, at] = self.pair_ranks(symbols[rows, at], symbols[rows, at + 1])

    def _merge_long(self, word: bytes) -> np.ndarray:
        """The same rounds for a matrix of one long row, compacted in place."""
        symbols = self.first[np.frombuffer(word, np.uint8)]
        ranks = self.pair_ranks(symbols[:-1], symbols[1:])
        size = len(symbols)
        while size > 1:
            spot = int(ranks[: size - 1].argmin())
            best = ranks[spot]
            if best == NO_PAIR:
                break
            symbols[spot] = best
            symbols[spot + 1 : size - 1] = symbols[spot + 2 : size].copy()
            ranks[spot : size - 2] = ranks[spot + 1 : size - 1].copy()
            size -= 1
            low, high = max(spot - 1, 0), min(spot + 1, size - 1)
            ranks[low:high] = self.pair_ranks(symbols[low:high], symbols[low + 1 : high + 1])
        return symbols[:size]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Encoder:
    """Texts to ids, with a memo of words that is emptied when it is full."""

    def __init__(self, content: bytes, pattern: str):
        self.table, self.split, self.memo = RankTable(content), Splitter(pattern), {}

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        words = [self.split(text) for text in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        new = list(set().union(*words).difference(self.memo)) if words else []
        self.memo.update(zip(new, self.table.encode_words([w.encode() for w in new]), strict=True))
        return (b"".join(map(self.memo.__getitem__, row)) for row in words)


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(content: bytes, pattern: str) -> Encoder:
    """The worker's encoder for this vocabulary; one is kept."""
    key = hashlib.sha256(content + pattern.encode()).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(content, pattern)
    return _ENCODERS[key]


def read_vocabulary(path: str) -> bytes:
    """The vocabulary file, which goes to the tasks as a broadcast; its size is checked here."""
    with open(path, "rb") as file:
        content = file.read(VOCABULARY_BYTES + 1)
    if len(content) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return content


def encode_texts(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids`` of each row's whole text: ids as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Rows are independent: repeated rows give repeated results, a
    null id stays null, an empty table gives no rows.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(content.value, pattern)
        for piece in pieces(batches):
            ids = pa.array(own.encode_batch(strings(piece["text"])), pa.binary())
            yield pa.RecordBatch.from_arrays([piece["doc_id"], ids], ["doc_id", "ids"])

    return keyed_texts(docs, id_col, text_col).mapInArrow(encode, "doc_id long, ids binary")


def decode_ids(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, ids, bytes``: the byte string that the ids stand for."""
    content = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(content.value, pattern).table
        for piece in pieces(batches, "ids"):
            raw = pa.array((own.decode(x or b"") for x in piece["ids"].to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*piece.columns, raw], ["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids binary, bytes binary")


def encode_and_decode(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids, bytes``: ``decode_ids`` of ``encode_texts`` in one pass.

    Two passes in one stage take two workers for each task, with a vocabulary each, which stay.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(content.value, pattern)
        for piece in pieces(batches):
            ids = list(own.encode_batch(strings(piece["text"])))
            raw = pa.array(map(own.table.decode, ids), pa.binary())
            yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(ids, pa.binary()), raw], ["doc_id", "ids", "bytes"])

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary, bytes binary")

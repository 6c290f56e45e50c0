"""Token counts by a heap and a linked list per word; no ids are produced.

The lowest-rank adjacent pair is popped again and again, entries whose symbols have changed since are
skipped, and the two neighbours of a merge are pushed. The count is initial symbols minus merges.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from edgewatch.llm.bpe_matrix import read_vocabulary
from edgewatch.llm.rows import keyed_texts, pieces, strings
from edgewatch.llm.word_split import Splitter

MEMO_WORDS = 1_000_000


def printable_bytes() -> list[str]:
    """The 256 letters that byte-level vocabularies write bytes with.

    Bytes that Latin-1 prints keep their letter, the others follow in order from code point 256.
    """
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(shifted)) for b in range(256)]


class Counter:
    """Counts of a byte-level BPE description without normalizer, with its added tokens."""

    def __init__(self, content: bytes, pattern: str):
        spec = json.loads(content)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        plain = (
            spec["normalizer"] is None
            and (model["type"], splitter["type"]) == ("BPE", "ByteLevel")
            and not splitter["add_prefix_space"]
            and not model["ignore_merges"]
            and not any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"])
        )
        if not plain:
            raise ValueError("not a plain byte-level BPE description")
        ids = model["vocab"]
        self.first = [ids[letter] for letter in printable_bytes()]
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.rank_of = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(merges)}.get
        self.joins = [ids[a + b] for a, b in merges]
        added = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.split, self.memo = Splitter(pattern), {}

    def count_word(self, word: str) -> int:
        first, rank_of, joins = self.first, self.rank_of, self.joins
        symbols = [first[b] for b in word.encode()]
        ranks = [rank_of(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
        heap = [rank << 32 | i for i, rank in enumerate(ranks) if rank >= 0]
        size = count = len(symbols)
        if not heap:
            return count
        heapify(heap)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        ranks.append(-1)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            if ranks[i] != top >> 32:
                continue
            j, joined = after[i], joins[top >> 32]
            k = after[i] = after[j]
            symbols[i], ranks[j] = joined, -1
            count -= 1
            if k < size:
                before[k] = i
                ranks[i] = rank = rank_of(joined << 32 | symbols[k], -1)
                if rank >= 0:
                    heappush(heap, rank << 32 | i)
            else:
                ranks[i] = -1
            h = before[i]
            if h >= 0:
                ranks[h] = rank = rank_of(symbols[h] << 32 | joined, -1)
                if rank >= 0:
                    heappush(heap, rank << 32 | h)
        return count

    def count_text(self, text: str) -> int:
        if self.added is None:
            return self._count_plain(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(map(self._count_plain, parts))

    def _count_plain(self, text: str) -> int:
        words, memo = self.split(text), self.memo
        try:
            return sum(map(memo.__getitem__, words))
        except KeyError:
            if len(memo) > MEMO_WORDS:
                memo.clear()
            for word in set(words).difference(memo):
                memo[word] = self.count_word(word)
        return sum(map(memo.__getitem__, words))


_COUNTERS: dict[bytes, Counter] = {}


def counter(content: bytes, pattern: str) -> Counter:
    """The worker's counter for this vocabulary; one is kept."""
    key = hashlib.sha256(content + pattern.encode()).digest()
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(content, pattern)
    return _COUNTERS[key]


def count_tokens(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each row's whole text.

    Added special tokens inside a text count as one token each. Null and empty texts have no tokens,
    repeated rows give repeated results, a null id stays null, an empty table gives no rows.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(content.value, pattern)
        for piece in pieces(batches):
            size = pc.fill_null(pc.binary_length(piece["text"]), 0).cast(pa.int64())
            n = pa.array(map(own.count_text, strings(piece["text"])), pa.int64())
            yield pa.RecordBatch.from_arrays([piece["doc_id"], size, n], ["doc_id", "n_bytes", "n_tokens"])

    return keyed_texts(docs, id_col, text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long"
    )

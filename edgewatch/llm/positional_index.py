"""A positional inverted index of documents, searched for exact phrases and for terms close together.

The index is partitioned by documents. One block of documents is one row of postings: for each indexed
term the ascending places of its occurrences, places counted through the block with a gap between
documents, so that no match crosses a document. Terms are hashed; a bitmap of fixed size, made from all test
items, leaves out most terms that no item uses. The index is built in one pass over the documents and
stored, whatever the size of the test set; test items are searched in it block by block. A search starts
from a phrase's rarest term and intersects the offset-adjusted lists of the others from rare to frequent, so
it stops early for phrases that a block does not hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewatch.llm.rows import keyed_texts, pieces, text_digest
from edgewatch.llm.word_hash import word_hashes
from edgewatch.session import keep_after_scope, kept_after_scope, materialize, scratch_scope

BLOCK_BYTES = 8 << 20
ITEM_BLOCK_BYTES = 8 << 20
FILTER_BITS = 24
POSTINGS = (
    "rows array<bigint>, digests array<bigint>, doc_ids array<bigint>, firsts array<bigint>, words array<bigint>, terms array<bigint>, "
    "starts array<bigint>, places array<int>"
)


class Phrases:
    """A block of test items as distinct windows over a vocabulary of term hashes.

    ``windows`` has vocabulary numbers, -1 behind a short window. ``owners`` lists the items of each
    window. An item with fewer words than ``size`` is one window, an item without words is none.
    """

    def __init__(self, items: list[tuple[object, str | None]], size: int):
        owners: dict[bytes, list[str]] = {}
        hashes, counts = word_hashes([(text or "").encode() for _, text in items])
        for (item, _), words in zip(items, np.split(hashes, np.cumsum(counts)[:-1]), strict=False):
            starts = range(max(len(words) - size, 0) + 1) if len(words) else ()
            for window in {words[i : i + size].tobytes() for i in starts}:
                owners.setdefault(window, []).append("null" if item is None else str(item))
        self.size, self.owners = size, list(owners.values())
        self.vocabulary = np.unique(hashes)
        self.windows = np.full((len(owners), size), -1, np.int64)
        for row, window in zip(self.windows, owners, strict=True):
            terms = np.frombuffer(window, np.uint64)
            row[: len(terms)] = np.searchsorted(self.vocabulary, terms)


class Block:
    """The postings of one block of documents."""

    def __init__(self, rows, digests, doc_ids, firsts, words, terms, starts, places):
        self.rows, self.digests, self.doc_ids, self.firsts, self.words = rows, digests, doc_ids, firsts, words
        self.terms, self.starts, self.places = terms, starts, places

    @classmethod
    def of(cls, rows: list[int], digests: list[int], doc_ids: list[int | None], texts: list[bytes], wanted: np.ndarray, gap: int) -> Block:
        """``wanted`` is the bitmap of ``term_filter``."""
        hashes, counts = word_hashes(texts)
        firsts = np.cumsum(counts + gap) - counts - gap
        known = np.flatnonzero(_in_filter(hashes, wanted))
        place = known + np.repeat(np.arange(len(counts)) * gap, counts)[known]
        terms, term = np.unique(hashes[known], return_inverse=True)
        order = np.argsort(term.astype(np.uint16) if len(terms) <= 1 << 16 else term, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(terms)))))
        return cls(rows, digests, doc_ids, firsts, counts, terms, starts, place[order].astype(np.int32))

    def lists(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of each vocabulary term's list; the last entry stands for no term."""
        starts, sizes = np.zeros((2, len(vocabulary) + 1), np.int64)
        if len(self.terms):
            at = np.searchsorted(self.terms, vocabulary)
            at[at == len(self.terms)] = 0
            held = np.flatnonzero(self.terms[at] == vocabulary)
            starts[held], sizes[held] = self.starts[at[held]], np.diff(self.starts)[at[held]]
        return starts, sizes

    def searchable(self, phrases: Phrases) -> Iterator[tuple[int, list[tuple[int, np.ndarray]]]]:
        """Windows whose terms all occur here: (offset, places) of their terms, rarest first."""
        starts, sizes = self.lists(phrases.vocabulary)
        found = np.where(phrases.windows >= 0, sizes[phrases.windows], np.iinfo(np.int64).max)
        alive = np.flatnonzero((found > 0).all(axis=1))
        for number, order in zip(alive.tolist(), found[alive].argsort(axis=1, kind="stable"), strict=True):
            window = phrases.windows[number]
            order = order[: np.count_nonzero(window >= 0)].tolist()
            yield number, [(i, self.places[starts[t] : starts[t] + sizes[t]]) for i in order for t in [window[i]]]

    @staticmethod
    def phrase(terms: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """Places at which a whole window stands, in order: offset-adjusted lists intersected."""
        found = terms[0][1] - np.int32(terms[0][0])
        for offset, places in terms[1:]:
            wanted = found + np.int32(offset)
            near = np.minimum(np.searchsorted(places, wanted), len(places) - 1)
            found = found[places[near] == wanted]
            if not len(found):
                break
        return found

    @staticmethod
    def near(terms: list[tuple[int, np.ndarray]], span: int) -> np.ndarray:
        """Places of the rarest term at which all terms stand within ``span`` places, in any order."""
        own = terms[0][1]
        found = []
        for start in range(-span + 1, 1):  # each span of that length around the rarest term
            held = np.ones(len(own), bool)
            for _, places in terms[1:]:
                at = np.searchsorted(places, own + np.int32(start))
                held &= places[np.minimum(at, len(places) - 1)] - own - start < span
                held &= at < len(places)
            found.append(own[held])
        return np.unique(np.concatenate(found))

    def doc_at(self, places: np.ndarray) -> np.ndarray:
        """Numbers of the documents that hold the places."""
        return np.searchsorted(self.firsts, places, side="right") - 1


def _in_filter(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - FILTER_BITS)
    return (wanted[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def term_filter(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> np.ndarray:
    """A bitmap of ``2 ** FILTER_BITS`` bits over the leading bits of all test terms' hashes."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << FILTER_BITS - 6, np.uint64)
        for piece in pieces(batches):
            place = np.unique(word_hashes([t or b"" for t in piece["text"].to_pylist()])[0] >> np.uint64(64 - FILTER_BITS))
            np.bitwise_or.at(own, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(own[used].view(np.int64))], ["at", "bits"])

    texts = keyed_texts(items, id_col, text_col).select(F.col("text").cast("binary").alias("text"))
    marked = texts.mapInArrow(mark, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    whole = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    for at, bits in marked.collect():
        whole[at] = np.int64(bits).view(np.uint64)
    return whole


def build_index(
    docs: DataFrame, wanted: np.ndarray, gap: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The postings of the terms in the bitmap ``wanted``, one row per block of documents.

    Every document row has a number of its own, so rows with a null id or with one id stay apart.
    """
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=BLOCK_BYTES):
            texts = [t or b"" for t in piece["text"].to_pylist()]
            names = (piece[c].to_pylist() for c in ("row", "digest", "doc_id"))
            b = Block.of(*names, texts, shared.value, gap)
            columns = [b.rows, b.digests, b.doc_ids, b.firsts, b.words, b.terms.view(np.int64), b.starts, b.places]
            kinds = [pa.int64()] * 7 + [pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [_one_list(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["rows", "digests", "doc_ids", "firsts", "words", "terms", "starts", "places"],
            )

    rows = keyed_texts(docs, id_col, text_col).withColumns(
        {"digest": text_digest(F.col("text")), "text": F.col("text").cast("binary"), "row": F.monotonically_increasing_id()}
    )
    return rows.mapInArrow(index, POSTINGS)


def _one_list(values, kind: pa.DataType) -> pa.Array:
    flat = pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for row in range(batch.num_rows):
            *names, firsts, words, terms, starts, places = (batch.column(i)[row].values for i in range(8))
            arrays = [x.to_numpy() for x in (firsts, words, terms, starts, places)]
            arrays[2] = arrays[2].view(np.uint64)
            yield Block(*(x.to_pylist() for x in names), *arrays)


MATCHES = "row bigint, digest bigint, doc_id bigint, n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>"


def find_phrases(index: DataFrame, phrases: Phrases) -> DataFrame:
    """``row, digest, doc_id, n_words, starts, ends, items`` of every document row.

    ``starts`` and ``ends`` bound the runs of words, counted from 0, that lie in matches; ``items`` are
    the test items with a matching window.
    """
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = shared.value
        for block in _blocks(batches):
            size = int((block.firsts + block.words).max(initial=0)) + 1
            delta = np.zeros(size + 1, np.int32)
            items: list[set] = [set() for _ in block.doc_ids]
            for number, terms in block.searchable(sought):
                found = block.phrase(terms)
                if len(found):
                    np.add.at(delta, found, 1)
                    np.add.at(delta, found + len(terms), -1)
                    for doc in set(block.doc_at(found).tolist()):
                        items[doc].update(sought.owners[number])
            edges = np.flatnonzero(np.diff(np.cumsum(delta) > 0, prepend=False))
            starts, ends = edges[0::2], edges[1::2]
            doc = block.doc_at(starts)
            at = np.searchsorted(doc, np.arange(len(block.doc_ids) + 1))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in (block.rows, block.digests, block.doc_ids)), pa.array(block.words),
                 *(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x - block.firsts[doc]))
                   for x in (starts, ends)),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                ["row", "digest", "doc_id", "n_words", "starts", "ends", "items"],
            )

    return index.mapInArrow(search, MATCHES)


def find_near(index: DataFrame, phrases: Phrases, span: int) -> DataFrame:
    """``row, doc_id, items`` of document rows with all terms of a window inside ``span`` words, in any order."""
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = shared.value
        for block in _blocks(batches):
            items: dict[int, set] = {}
            for number, terms in block.searchable(sought):
                for doc in set(block.doc_at(block.near(terms, span)).tolist()):
                    items.setdefault(doc, set()).update(sought.owners[number])
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.rows[d] for d in items], pa.int64()),
                 pa.array([block.doc_ids[d] for d in items], pa.int64()),
                 pa.array([sorted(x) for x in items.values()], pa.list_(pa.string()))],
                ["row", "doc_id", "items"],
            )

    return index.mapInArrow(search, "row bigint, doc_id bigint, items array<string>")


def item_blocks(items: DataFrame, id_col: str, text_col: str, size: int, limit: int) -> Iterator[Phrases]:
    """The test items in blocks of about ``limit`` bytes, each small enough to go to every task."""
    rows = keyed_texts(items, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // limit) or 1
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))
    for number in range(n):
        yield Phrases([tuple(r) for r in rows.filter(block == number).collect()], size)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """``row, digest, doc_id, n_words, starts, ends, items``: where documents hold windows of test items.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. Null and empty
    texts have no words. One row per document row, known by ``row``, ``digest`` tells texts apart: repeated rows give repeated results,
    and rows with a null id or one id but different texts keep their own. The stored index is searched for
    ``block_bytes`` of test items at a time, and the runs that the blocks find are united.
    """
    with scratch_scope(docs.sparkSession):
        wanted = term_filter(items, item_id_col, item_text_col)
        index = materialize(build_index(docs, wanted, window, id_col, text_col), "postings")
        blocks = item_blocks(items, item_id_col, item_text_col, window, block_bytes)
        found = [materialize(find_phrases(index, phrases), "matches") for phrases in blocks]
        return kept_after_scope(_united(found), "contamination") if len(found) > 1 else keep_after_scope(found[0])


def _united(found: list[DataFrame]) -> DataFrame:
    """The runs and items that several blocks of test items have in each document row."""
    one = found[0]
    for other in found[1:]:
        one = one.unionByName(other)
    runs = F.zip_with("starts", "ends", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    united = one.groupBy("row", "digest", "doc_id", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list(runs))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    merged = F.aggregate(
        "runs",
        F.slice("runs", 1, 1),
        lambda done, run: F.when(
            run["a"] <= F.element_at(done, -1)["b"],
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["a"].alias("a"),
                                 F.greatest(F.element_at(done, -1)["b"], run["b"]).alias("b"))),
            ),
        ).otherwise(F.concat(done, F.array(run))),
    )
    return united.withColumn("runs", merged).select(
        "row", "digest", "doc_id", "n_words", F.col("runs.a").alias("starts"), F.col("runs.b").alias("ends"), "items"
    )

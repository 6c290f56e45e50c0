"""Document fingerprints as invertible Bloom lookup tables of paragraph digests.

A text's paragraphs (sentences of long paragraphs) are hashed into the cells of three sub-tables. A cell
holds a count, a sum of digests and a sum of checks. The tables of two versions are subtracted, which
cancels what both have; a cell that then holds one digest gives it away, and taking it out of its other
cells uncovers more. If cells are left over, the two tables are built again twice as large.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewatch.llm.rows import PIECE_BYTES, keyed_texts, pieces, strings
from edgewatch.llm.word_hash import mixed, run_hashes

BASE_WIDTH = 4
TABLES = 3
LEAST_ID = -(2**63)
#: A space after one of these ends a unit, a line break always does.
SENTENCE_ENDS = np.zeros(256, bool)
SENTENCE_ENDS[list(b".!?")] = True


class Paragraphs:
    """Digests of the paragraphs of many texts: ``keys`` in text order, ``counts`` per text.

    The n-th repetition of a paragraph inside a text has a digest of its own.
    """

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        stop = raw == 10
        stop[1:] |= (raw[1:] == 32) & SENTENCE_ENDS[raw[:-1]]
        hashes, self.counts = run_hashes(raw, ~stop, np.cumsum([len(t) + 1 for t in texts]))
        self.owner = np.repeat(np.arange(len(texts)), self.counts)
        order = np.lexsort((hashes, self.owner))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (self.owner[order][1:] != self.owner[order][:-1])
        run = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        turn = np.empty(len(order), np.uint64)
        turn[order] = np.arange(len(order)) - run
        self.keys = mixed(hashes + turn * np.uint64(0x9E3779B97F4A7C15))
        self.starts = np.cumsum(self.counts) - self.counts

    def of(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the chosen texts one after another, and the position of each key's text."""
        sizes = self.counts[texts]
        position = np.repeat(np.arange(len(texts)), sizes)
        inner = np.arange(len(position)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.keys[self.starts[texts][position] + inner], position


class Cells:
    """The tables of many sketches side by side: ``width`` cells in each of the sub-tables of each."""

    def __init__(self, sketches: int, width: int):
        self.width = width
        self.count = np.zeros(sketches * TABLES * width, np.int64)
        self.keys, self.checks = np.zeros((2, len(self.count)), np.uint64)

    def at(self, sketch: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The cells of each key, a row per sub-table."""
        places = [(keys >> np.uint64(20 * i)) & np.uint64(self.width - 1) for i in range(TABLES)]
        return np.stack([(sketch * TABLES + i) * self.width + p.astype(np.int64) for i, p in enumerate(places)])

    def add(self, sketch: np.ndarray, keys: np.ndarray, signs: np.ndarray | int) -> None:
        signs = np.broadcast_to(np.asarray(signs, np.int64), keys.shape)
        wrapped = signs.astype(np.uint64)  # -1 as its complement: products and sums are modulo 2^64
        for row in self.at(sketch, keys):
            np.add.at(self.count, row, signs)
            np.add.at(self.keys, row, keys * wrapped)
            np.add.at(self.checks, row, mixed(keys ^ np.uint64(1)) * wrapped)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sketch number, digest and sign of everything that can be recovered; the cells are emptied."""
        found = []
        while True:
            one = np.flatnonzero(np.abs(self.count) == 1)
            signs = self.count[one]
            keys = self.keys[one] * signs.astype(np.uint64)
            pure = self.checks[one] * signs.astype(np.uint64) == mixed(keys ^ np.uint64(1))
            if not pure.any():
                break
            sketch = one[pure] // (TABLES * self.width)
            keys, signs = keys[pure], signs[pure]
            order = np.lexsort((keys, sketch))
            sketch, keys, signs = sketch[order], keys[order], signs[order]
            once = np.ones(len(keys), bool)
            once[1:] = (keys[1:] != keys[:-1]) | (sketch[1:] != sketch[:-1])
            sketch, keys, signs = sketch[once], keys[once], signs[once]
            self.add(sketch, keys, -signs)
            found.append((sketch, keys, signs))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def empty(self) -> np.ndarray:
        """Which sketches have nothing left."""
        left = (self.count != 0) | (self.keys != 0)
        return ~left.reshape(-1, TABLES * self.width).any(axis=1)


def fingerprints(paragraphs: Paragraphs) -> list[str]:
    """The smallest table of each text with its number of paragraphs, in base 64."""
    cells = Cells(len(paragraphs.counts), BASE_WIDTH)
    cells.add(paragraphs.owner, paragraphs.keys, 1)
    n = TABLES * BASE_WIDTH
    packed = np.zeros(len(paragraphs.counts), [("n", "<u4"), ("c", "<i4", n), ("k", "<u8", n), ("x", "<u4", n)])
    packed["n"] = paragraphs.counts
    packed["c"], packed["k"] = cells.count.reshape(-1, n), cells.keys.reshape(-1, n)
    packed["x"] = cells.checks.reshape(-1, n) & np.uint64(0xFFFFFFFF)
    return [base64.b64encode(row.tobytes()).decode() for row in packed]


def differences(
    paragraphs: Paragraphs, old: np.ndarray, new: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair number, digest and sign (1: only in the old text, -1: only in the new) of each difference.

    ``old`` and ``new`` are the text numbers of each pair. Pairs whose tables do not come out empty are
    tried again with tables of twice the width.
    """
    open_, width, found = np.arange(len(old)), BASE_WIDTH, []
    while len(open_):
        cells = Cells(len(open_), width)
        for texts, sign in ((old, 1), (new, -1)):
            keys, position = paragraphs.of(texts[open_])
            cells.add(position, keys, sign)
        sketch, keys, signs = cells.peel()
        done = cells.empty()
        kept = done[sketch]
        found.append((open_[sketch[kept]], keys[kept], signs[kept]))
        open_, width = open_[~done], 2 * width
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def likeness(paragraphs: Paragraphs, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Common paragraphs over all paragraphs of each pair, from the recovered differences."""
    pair, _, signs = differences(paragraphs, old, new)
    gone = np.bincount(pair[signs > 0], minlength=len(old))
    came = np.bincount(pair[signs < 0], minlength=len(old))
    union = paragraphs.counts[old] + came
    return np.where(union == 0, 1.0, (paragraphs.counts[old] - gone) / np.maximum(union, 1))


def compare_versions(pairs: DataFrame, id_col: str, old_col: str, new_col: str) -> DataFrame:
    """``id, old_fingerprint, new_fingerprint, removed, added, likeness`` of two versions of a text.

    ``removed`` and ``added`` are the digests of the paragraphs that only one version has. Null and empty
    texts have no paragraphs; two such texts are alike. Repeated rows give repeated results.
    """
    rows = keyed_texts(pairs, id_col, old_col).schema  # both columns must exist
    versions = pairs.select(
        F.col(f"`{id_col}`").cast(rows["doc_id"].dataType).alias("id"),
        F.coalesce(F.col(f"`{old_col}`"), F.lit("")).alias("old"),
        F.coalesce(F.col(f"`{new_col}`"), F.lit("")).alias("new"),
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "old"):
            n = piece.num_rows
            texts = strings(piece["old"]) + strings(piece["new"])
            paragraphs = Paragraphs([t.encode() for t in texts])
            old, new = np.arange(n), np.arange(n, 2 * n)
            pair, keys, signs = differences(paragraphs, old, new)
            prints = fingerprints(paragraphs)
            lists = [
                pa.array([np.sort(keys[(pair == i) & (signs == s)]).view(np.int64) for i in range(n)], pa.list_(pa.int64()))
                for s in (1, -1)
            ]
            yield pa.RecordBatch.from_arrays(
                [piece["id"], pa.array(prints[:n]), pa.array(prints[n:]), *lists,
                 pa.array(likeness(paragraphs, old, new))],
                ["id", "old_fingerprint", "new_fingerprint", "removed", "added", "likeness"],
            )

    return versions.mapInArrow(
        compare,
        "id long, old_fingerprint string, new_fingerprint string, removed array<bigint>, "
        "added array<bigint>, likeness double",
    )


# --- each document against an edit of itself and its successor ----------------------------------


def successors(docs: DataFrame) -> DataFrame:
    """Rows in runs: ``bucket, extra, doc_id, text``, sorted inside partitions by descending id.

    The row after a row of the same bucket is its successor. Buckets are ranges of ids; the first row
    of a bucket also ends the bucket before it (``extra``), that of the first bucket ends the last one.
    Only ids are gathered to place the ranges, one per bucket.
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("key", F.coalesce("doc_id", F.lit(LEAST_ID)))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = keyed.approxQuantile("key", [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    bounds = np.unique(np.array(cuts, np.float64))

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series) -> pd.Series:
        return pd.Series((len(bounds) - np.searchsorted(bounds, key.to_numpy(np.float64))).astype(np.int32))

    placed = keyed.withColumn("bucket", bucket_of("key"))
    heads = [tuple(r) for r in placed.groupBy("bucket").agg(F.max("key")).orderBy("bucket").collect()]
    before = spark.createDataFrame(
        [(b, key, heads[i - 1][0]) for i, (b, key) in enumerate(heads)], "head_of int, head long, ends int"
    )
    rows = placed.join(
        F.broadcast(before), (F.col("bucket") == F.col("head_of")) & (F.col("key") == F.col("head")), "left"
    )
    own = F.struct(F.col("bucket"), F.lit(0).alias("extra"))
    as_end = F.struct(F.col("ends").alias("bucket"), F.lit(1).alias("extra"))
    copies = F.explode(F.when(F.col("ends").isNull(), F.array(own)).otherwise(F.array(own, as_end)))
    spread = rows.select(copies.alias("at"), "doc_id", "key", "text", F.xxhash64("text").alias("tie"))
    spread = spread.select("at.*", "doc_id", "key", "text", "tie").repartition("bucket")
    ordered = spread.sortWithinPartitions("bucket", "extra", F.desc("key"), "tie")
    return ordered.select("bucket", "extra", "doc_id", "text")


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of ``(doc_id, text, next text)``, of bounded size."""
    held, out, size = None, [], 0
    for piece in pieces(batches):
        for row in zip(*(piece[c].to_pylist() for c in ("bucket", "extra", "doc_id", "text")), strict=True):
            if held and held[0] == row[0] and not held[1]:
                out.append((held[2], held[3] or "", row[3] or ""))
                size += len(out[-1][1]) + len(out[-1][2])
            held = row
            if size >= PIECE_BYTES:
                yield out
                out, size = [], 0
    if out:
        yield out


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against a version whose second half is the start of the next document.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The next
    document is that of the next smaller id, after the smallest the largest; null ids are smaller than
    all others; of equal ids the order is that of a hash of their texts. The last ``n_chars // 2`` code
    points give way to as many of the next text, or to all of it. Null texts are empty. The nearness of
    two texts is the share of common paragraphs, 1 for two texts without any.
    """
    rows = keyed_texts(docs, id_col, text_col)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chain in _with_next(batches):
            n = len(chain)
            edited = [text[: len(text) - len(text) // 2] + after[: len(text) // 2] for _, text, after in chain]
            texts = [x.encode() for x in (*(t for _, t, _ in chain), *edited, *(a for _, _, a in chain))]
            paragraphs = Paragraphs(texts)
            prints = fingerprints(paragraphs)
            own = np.arange(n)
            near = likeness(paragraphs, np.concatenate((own, own)), np.arange(n, 3 * n))
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _, _ in chain], pa.int64()), pa.array([len(t) for _, t, _ in chain], pa.int64()),
                 pa.array([hashlib.sha256(e).hexdigest() for e in texts[n : 2 * n]]),
                 pa.array(prints[:n]), pa.array(prints[n : 2 * n]), pa.array(near[:n]), pa.array(near[n:])],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return successors(rows).mapInArrow(
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )

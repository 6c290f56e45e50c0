"""Importance resampling towards a target corpus, with weights from bit planes.

Features are runs of consecutive words, hashed into buckets. A bucket's gain is the scaled log ratio of
its smoothed shares in the target and in the corpus. A document's weight is the sum of gains over its
features: its bucket counts are cut into planes of one bit per bucket, the gains likewise into planes of
their sign and magnitude, and every pair of planes gives its popcount of common bits times a power of two.
The documents with the greatest sums of weight and Gumbel noise are drawn, which samples without
replacement in proportion to the exponentials of the weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgewatch.llm.rows import column, pieces
from edgewatch.llm.word_hash import WORD_BYTES
from edgewatch.session import materialize

#: A-Z become a-z, bytes that are in no word become spaces.
_PLAIN = bytes(b if WORD_BYTES[b] else 0x20 for b in bytes(range(256)).lower())
MEMO_WORDS = 500_000
GROUP_CELLS = 1 << 20
ROWS_PER_SLICE = 500_000


class Buckets(dict):
    """Bucket of a feature; forgets everything when it has grown to ``MEMO_WORDS``, for speed alone."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        # features of great length are rare and would fill the memo's memory
        bucket = crc32(feature) % self.n
        if len(feature) <= 64:
            self[feature] = bucket
        return bucket


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def features_of(words: list[bytes], most_words: int) -> list[bytes]:
    """All runs of one to ``most_words`` consecutive words, joined by one space."""
    found = list(words)
    for n in range(2, most_words + 1):
        found += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return found


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("binary").alias("text")
    )


def bucket_totals(docs: DataFrame, buckets: int, most_words: int, text_col: str = "text") -> np.ndarray:
    """Features of all rows per bucket. The driver gets one row for each of the ``buckets``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, bucket_of = np.zeros(buckets, np.int64), Buckets(buckets)
        for piece in pieces(batches):
            for text in piece["text"].to_pylist():
                found = features_of(words_of(text or b""), most_words)
                at = np.fromiter(map(bucket_of.__getitem__, found), np.int64, len(found))
                totals += np.bincount(at, minlength=buckets)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["bucket", "n"])

    texts = docs.select(column(docs, text_col).cast("binary").alias("text"))
    counted = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():
        totals[bucket] = n
    return totals


def bucket_gains(corpus: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """Gain of each bucket from the counts of corpus and target, smoothed by one feature per bucket."""
    more, whole = len(corpus), (float(corpus.sum()), float(target.sum()))
    return np.array(
        [
            math.floor(scale * math.log(((t + 1) * (whole[0] + more)) / ((s + 1) * (whole[1] + more))))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of whole numbers that are not negative: ``[bit, ..., 64-bit word]``, lowest bit first."""
    width = -values.shape[-1] % 64
    padded = np.pad(values, [(0, 0)] * (values.ndim - 1) + [(0, width)])
    bits = int(values.max(initial=0)).bit_length()
    cut = [np.packbits((padded >> b & 1).astype(bool), axis=-1, bitorder="little").view(np.uint64) for b in range(bits)]
    return np.stack(cut) if cut else np.zeros((0, *padded.shape[:-1], padded.shape[-1] // 64), np.uint64)


class SignedPlanes:
    """Gains as planes of their magnitude, apart for either sign."""

    def __init__(self, gains: np.ndarray):
        self.sides = [(1, planes(np.maximum(gains, 0))), (-1, planes(np.maximum(-gains, 0)))]

    def weights(self, counts: np.ndarray) -> np.ndarray:
        """Sums of gain times count for each row of ``counts``, exact in 64 bits."""
        own = planes(counts)
        total = np.zeros(len(counts), np.int64)
        for sign, side in self.sides:
            for i, gain in enumerate(side):
                for j, plane in enumerate(own):
                    common = np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
                    total += sign * (common << i + j)
        return total


def document_weights(
    docs: DataFrame, gains: np.ndarray, most_words: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed, n, bucket_of = SignedPlanes(gains), len(gains), Buckets(len(gains))
        rows = max(GROUP_CELLS // n, 1)
        for piece in pieces(batches):
            texts = [t or b"" for t in piece["text"].to_pylist()]
            n_words, n_features, weights = [], [], [np.empty(0, np.int64)]
            for start in range(0, len(texts), rows):
                group = [words_of(t) for t in texts[start : start + rows]]
                found = [features_of(words, most_words) for words in group]
                counts = np.zeros((len(group), n), np.int64)
                for row, own in enumerate(found):
                    at = np.fromiter(map(bucket_of.__getitem__, own), np.int64, len(own))
                    counts[row] = np.bincount(at, minlength=n)
                n_words += map(len, group)
                n_features += map(len, found)
                weights.append(signed.weights(counts))
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
                 pa.array(np.concatenate(weights))],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    schema = "doc_id long, n_words long, n_features long, weight long"
    return _texts(docs, id_col, text_col).mapInArrow(weigh, schema)


def noise(doc_id: Column, seed: int, scale: int = 1000) -> Column:
    """Gumbel noise of a document, in whole units of ``1 / scale``, from a digest of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.ln(-F.ln((drawn + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, wanted: int) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3 ... for the first ``wanted`` by score, then ``doc_id``; else null.

    Rows with ``eligible`` are sorted by range partitioning; a rank is a row's place in its partition
    plus the sizes of the partitions before. Null ids come last among equal scores.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    slices = max(1, -(-rows.count() // ROWS_PER_SLICE))
    # all columns take part, so that equal scores and repeated ids cannot fill one partition's range
    keys = [*order, F.col("weight").desc(), F.col("row").asc()]
    chosen = rows.filter("eligible").repartitionByRange(slices, *keys).withColumn("part", F.spark_partition_id())
    chosen = materialize(chosen, "ranked")
    sizes = chosen.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*keys))
    placed = chosen.withColumn("place", place).join(F.broadcast(offsets), "part")
    placed = placed.withColumn("rank", (F.col("place") + F.col("before")).cast("long")).drop("part", "place", "before")
    placed = placed.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = rows.filter("NOT eligible").withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    buckets: int = 10_000,
    most_words: int = 1,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for every row of ``docs``.

    ``rank`` numbers the drawn documents from 1 by falling score, ties by smaller id; it is null for the
    others. Drawn are ``floor(percent * N / 100)`` of the ``N`` rows with at least ``least_words`` words.
    Null, empty and wordless texts have no features and the weight 0. An empty target has smoothed shares
    only. Repeated rows are rows of their own, each of which can be drawn; a null id draws its noise from
    the seed alone and comes last among equal scores. Other columns are not read.
    """
    corpus = bucket_totals(docs, buckets, most_words, text_col)
    gains = bucket_gains(corpus, bucket_totals(target, buckets, most_words, text_col))
    weighed = document_weights(docs, gains, most_words, id_col, text_col)
    scored = weighed.select(
        "*",
        (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"),
        (F.col("n_words") >= least_words).alias("eligible"),
        F.monotonically_increasing_id().alias("row"),
    )
    scored = materialize(scored, "scored")
    wanted = percent * scored.filter("eligible").count() // 100
    return ranked(scored, wanted).drop("eligible", "row")

"""Language identification by prediction by partial matching.

Each language has a byte context tree of variable order: counts of the bytes that follow every context of
up to ``ORDER`` bytes. A byte that its context has not seen costs an escape, whose probability grows
with the number of distinct bytes seen there, and is coded in the next shorter context; beyond the
empty context all bytes are alike. The statistics are frozen after training, so the code length of a
text in a language is exact, and the language that codes it shortest wins. The trees of all languages
are tables from context and byte to one code length per language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewatch.llm.hash_table import HashTable
from edgewatch.llm.rows import column, pieces, with_carried

ORDER = 4
WIDTH = ORDER + 1
PAD = b"\n" * ORDER
TRAIN_DOCS = 1_000
PIECE_BYTES = 1 << 19
MODEL_BYTES = 256 << 20
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each byte with the ``ORDER`` bytes before it as one integer; start and end of each text's run.

    Grams between the runs reach over the padding of the next text.
    """
    raw = np.frombuffer(b"".join(PAD + t for t in texts) + PAD, np.uint8).astype(np.uint64)
    grams = np.zeros(len(raw) - ORDER, np.uint64)
    for i in range(WIDTH):
        grams = grams << np.uint64(8) | raw[i : len(raw) - ORDER + i]
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + ORDER) - sizes - ORDER
    return grams, starts, starts + sizes


def _low(grams: np.ndarray, n: int) -> np.ndarray:
    return grams & np.uint64((1 << 8 * n) - 1)


def plain(text: str | None) -> bytes:
    """What is coded: the text in lower case."""
    return (text or "").lower().encode()


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``lang, gram, n`` over rows of ``lang, text``; summed in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=4 * PIECE_BYTES):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(piece["lang"].to_pylist(), piece["text"].to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(plain(text))
            for lang, texts in by_lang.items():
                grams, starts, ends = _grams(texts)
                inside = np.zeros(len(grams) + 1, np.int8)
                np.add.at(inside, starts, 1)
                np.add.at(inside, ends, -1)
                own, n = np.unique(grams[np.cumsum(inside[:-1]) > 0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(own.view(np.int64)), pa.array(n, pa.int64())],
                    ["lang", "gram", "n"],
                )

    counted = labelled.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Frozen code lengths in bits: ``coded[k]`` of a gram of k bytes, ``escape[k]`` after a context of k bytes."""

    def __init__(self, counts: pd.DataFrame):
        self.langs = sorted(counts["lang"].unique().tolist())
        number = counts["lang"].map({lang: i for i, lang in enumerate(self.langs)}).to_numpy(np.int64)
        grams, n = counts["gram"].to_numpy().view(np.uint64), counts["n"].to_numpy()
        keys, tallies = [], []
        for k in range(WIDTH + 1):
            own, at = np.unique(_low(grams, k), return_inverse=True)
            tally = np.zeros((len(own), len(self.langs)))
            np.add.at(tally, (at, number), n)
            keys.append(own)
            tallies.append(tally)
        coded, escapes, contexts = [np.full((1, len(self.langs)), 8.0)], [], []
        for k in range(1, WIDTH + 1):
            context, at = np.unique(keys[k] >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((2, len(context), len(self.langs)))
            np.add.at(total, at, tallies[k])
            np.add.at(kinds, at, tallies[k] > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0.0)
                seen = -np.log2(tallies[k] / (total + kinds)[at])
            shorter = coded[-1][np.searchsorted(keys[k - 1], _low(keys[k], k - 1))]
            coded.append(np.where(tallies[k] > 0, seen, escape[at] + shorter))
            escapes.append(escape)
            contexts.append(context)
        self.coded = [x.astype(np.float32) for x in coded]
        self.escape = [x.astype(np.float32) for x in escapes]
        self.grams, self.contexts = (
            [HashTable(k, np.arange(len(k), dtype=np.int32), np.int32(-1)) for k in lists]
            for lists in (keys, contexts)
        )

    def size(self) -> int:
        return sum(x.nbytes for x in (*self.coded, *self.escape)) + sum(
            t.keys.nbytes + t.values.nbytes for t in (*self.grams, *self.contexts)
        )

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        grams, starts, ends = _grams(texts)
        lengths = np.zeros((len(grams), len(self.langs)), np.float32)
        open_ = np.arange(len(grams))
        for k in range(WIDTH, 0, -1):
            at = self.grams[k].find(_low(grams[open_], k))
            hit = at >= 0
            lengths[open_[hit]] += self.coded[k][at[hit]]
            open_ = open_[~hit]
            before = self.contexts[k - 1].find(_low(grams[open_] >> np.uint64(8), k - 1))
            known = before >= 0
            lengths[open_[known]] += self.escape[k - 1][before[known]]
        lengths[open_] += self.coded[0][0]
        sums = np.add.reduceat(lengths, np.stack((starts, ends), 1).ravel(), axis=0, dtype=np.float64)[0::2]
        sums[starts == ends] = 0
        return sums

    def identify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, its share of the probability at equal priors, bits a byte, and whether a text has a letter."""
        lettered = np.array([bool(t) and LETTER.search(t) is not None for t in texts])
        best, score, rate = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        rows = np.flatnonzero(lettered)
        if len(rows) and self.langs:
            coded = [plain(texts[i]) for i in rows]
            bits = self.bits(coded)
            winner = bits.argmin(axis=1)
            least = bits.min(axis=1)
            score[rows] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            rate[rows] = least / [len(t) for t in coded]
            for i, w in zip(rows.tolist(), winner.tolist(), strict=True):
                best[i] = self.langs[w]
        return best, score, rate, lettered


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; a null id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train_docs: int = TRAIN_DOCS,
) -> Model:
    """A model from about ``train_docs`` labelled documents of each language, none of them held out.

    The sample is taken by a hash of the id, its share by the language's count; whole texts are learned.
    """
    labelled = docs.select(
        column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"), column(docs, lang_col).alias("lang")
    ).filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals = labelled.groupBy("lang").count().collect()
    share = F.lit(0)
    for row in totals:
        kept = min(1_000_000, -(-1_000_000 * train_docs // row["count"]))
        share = F.when(F.col("lang") == row["lang"], kept).otherwise(share)
    drawn = labelled.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < share)
    model = Model(gram_counts(drawn).toPandas())
    if model.size() > MODEL_BYTES:
        raise ValueError(f"the model has {model.size()} bytes; lower train_docs below {train_docs}")
    return model


def identify_language(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, lang, score, bits_per_byte, lettered, carried`` of each row's whole text.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned; of languages
    with equal code lengths the first by name. Repeated rows give repeated results. ``carried`` is a
    struct of the columns named in ``carry``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = with_carried(docs, carry, doc_id=column(docs, id_col).cast("long"), text=column(docs, text_col))
    kind = rows.schema["carried"].dataType.simpleString()

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PIECE_BYTES):
            lang, score, rate, lettered = shared.value.identify(piece["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], pa.array(lang), pa.array(score), pa.array(rate), pa.array(lettered), piece["carried"]],
                ["doc_id", "lang", "score", "bits_per_byte", "lettered", "carried"],
            )

    return rows.mapInArrow(
        identify, f"doc_id long, lang string, score double, bits_per_byte double, lettered boolean, carried {kind}"
    )

"""Lines that many documents share, found by probing sharded perfect-hash arrays.

A line's key has white space stripped at both ends and A-Z lower-cased. Digests of keys are counted
over all documents; those in enough documents go to shards by digest. One task per shard builds a
minimal perfect hash that indexes arrays of fingerprints, document counts and keepers (the largest id
that holds the line). Documents then probe the arrays. While all arrays fit ``BROADCAST_BYTES`` they go
to every task; beyond that the digests travel to the shards, salted, and only what must be dropped
comes back to its document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewatch.llm import perfect_hash
from edgewatch.llm.rows import column, pieces, with_carried
from edgewatch.session import materialize

SPACE = b" \t\n\x0b\x0c\r"
SHARD_LINES = 500_000
BROADCAST_BYTES = 64 << 20
GROUP_PROBES = 500_000
ARRAYS = "shard int, sizes binary, bits binary, prints binary, counts binary, keepers binary"
DIGEST = np.dtype([("place", "<u8"), ("print", "<u8")])


def _digests(text: bytes, min_chars: int) -> tuple[list[bytes], np.ndarray, list[bytes]]:
    """The lines of a text, the numbers of those with a long enough key, and the keys' digests."""
    lines = text.split(b"\n")
    lowered = lines if text.islower() else text.lower().split(b"\n")
    at, digests = [], []
    for i, line in enumerate(lowered):
        if len(line) >= min_chars:
            key = line.strip(SPACE)
            if len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode()) >= min_chars:
                at.append(i)
                digests.append(xxhash.xxh3_128_digest(key))
    return lines, np.array(at, np.int64), digests


def _keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), DIGEST)


def line_digests(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, place, print``: digests of a row's lines, each once. ``docs`` has ``doc_id, text``."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = [list(set(_digests(t or b"", min_chars)[2])) for t in piece["text"].to_pylist()]
            keys = _keys([d for row in found for d in row])
            owner = np.repeat(np.arange(len(found)), [len(row) for row in found])
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"].take(pa.array(owner)), *(_signed(keys[n]) for n in DIGEST.names)],
                ["doc_id", *DIGEST.names],
            )

    return docs.mapInArrow(digest, "doc_id long, place long, print long")


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``place, print, n_docs, keeper`` of the lines that at least ``min_docs`` rows hold."""
    counted = line_digests(docs, min_chars).groupBy("place", "print").agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper")
    )
    return counted.filter((F.col("n_docs") >= min_docs) & F.col("keeper").isNotNull())


def _shard(n: int):
    return F.pmod(F.shiftrightunsigned("place", 8), F.lit(n)).cast("int")


def build_shards(lines: DataFrame, n_shards: int) -> DataFrame:
    """One row of arrays per shard of ``repeated_lines``."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        place, check = (frame[n].to_numpy().view(np.uint64) for n in DIGEST.names)
        sizes, bits = perfect_hash.build(place, check)
        order = np.empty(len(frame), np.int64)
        order[perfect_hash.slots(sizes, bits, place, check)] = np.arange(len(frame))
        arrays = [sizes, bits, check[order], *(frame[n].to_numpy()[order] for n in ("n_docs", "keeper"))]
        row = [int(frame["shard"].iloc[0]), *(a.tobytes() for a in arrays)]
        return pd.DataFrame([row], columns=["shard", "sizes", "bits", "prints", "counts", "keepers"])

    return lines.withColumn("shard", _shard(n_shards)).groupBy("shard").applyInPandas(build, ARRAYS)


class Shard:
    """The arrays of one shard, ready to be probed."""

    def __init__(self, sizes: bytes, bits: bytes, prints: bytes, counts: bytes, keepers: bytes):
        self.sizes, self.bits = np.frombuffer(sizes, np.int64), np.frombuffer(bits, np.uint64)
        self.prints = np.frombuffer(prints, np.uint64)
        self.counts, self.keepers = np.frombuffer(counts, np.int64), np.frombuffer(keepers, np.int64)

    def probe(self, place: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are in the shard, and their slots."""
        slot = perfect_hash.slots(self.sizes, self.bits, place, check)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == check[known]
        return known, slot


def _drops(shards: dict[int, Shard], n_shards: int, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which of the digests name a line that another document keeps. Null ids are the least integer."""
    place, check = keys["place"].copy(), keys["print"].copy()
    home = (place >> np.uint64(8)) % np.uint64(n_shards)
    drop = np.zeros(len(keys), bool)
    for number, shard in shards.items():
        own = np.flatnonzero(home == number)
        known, slot = shard.probe(place[own], check[own])
        drop[own[known]] = shard.keepers[slot[known]] != ids[own[known]]
    return drop


def _ids(values: pa.Array) -> np.ndarray:
    return values.fill_null(np.iinfo(np.int64).min).to_numpy()


def _cut(piece: pa.RecordBatch, min_chars: int, decide) -> pa.RecordBatch:
    """The piece's rows without the lines for which ``decide(keys, row numbers)`` is true."""
    split = [_digests(t or b"", min_chars) for t in piece["text"].to_pylist()]
    owner = np.repeat(np.arange(len(split)), [len(s[2]) for s in split])
    drop = decide(_keys([d for s in split for d in s[2]]), owner)
    ends = np.cumsum([len(s[2]) for s in split])
    texts, totals, dropped = [], [], []
    for (lines, at, _), flags in zip(split, np.split(drop, ends[:-1]), strict=True):
        gone = set(at[flags].tolist())
        texts.append(b"\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else b"\n".join(lines))
        totals.append(len(lines))
        dropped.append(len(gone))
    return pa.RecordBatch.from_arrays(
        [piece["doc_id"], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(totals, pa.int64()),
         pa.array(dropped, pa.int64()), piece["carried"]],
        ["doc_id", "text", "n_lines", "n_dropped", "carried"],
    )


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
    min_chars: int = 20,
    min_docs: int = 3,
    broadcast_bytes: int = BROADCAST_BYTES,
    shard_lines: int = SHARD_LINES,
) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped, carried``: texts without lines that another row keeps.

    A line whose key has ``min_chars`` code points or more and is held by ``min_docs`` rows or more
    stays only in rows of the largest id that holds it. ``n_lines`` counts before dropping. A null or
    empty text has one empty line and comes back empty. Every row counts as a document of its own, so
    repeated rows count each; a null id is smaller than any other, and lines that only null ids hold
    stay. ``carried`` is a struct of the columns named in ``carry``.
    """
    spark = docs.sparkSession
    rows = with_carried(
        docs,
        carry,
        doc_id=column(docs, id_col).cast("long"),
        text=column(docs, text_col).cast("binary"),
    )
    lines = materialize(repeated_lines(rows.select("doc_id", "text"), min_chars, min_docs), "lines")
    n_lines = lines.count()
    n_shards = -(-n_lines // shard_lines) or 1
    arrays = materialize(build_shards(lines, n_shards), "line-arrays")
    held = F.octet_length("bits") + F.octet_length("prints") * 3
    size = arrays.agg(F.sum(held)).first()[0] or 0
    kind = rows.schema["carried"].dataType.simpleString()
    shape = f"doc_id long, text string, n_lines long, n_dropped long, carried {kind}"
    if size <= broadcast_bytes:
        packed = spark.sparkContext.broadcast([tuple(r) for r in arrays.collect()])

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shards = {r[0]: Shard(*r[1:]) for r in packed.value}
            for piece in pieces(batches):
                ids = _ids(piece["doc_id"])
                yield _cut(piece, min_chars, lambda k, o, ids=ids: _drops(shards, n_shards, k, ids[o]))

        return rows.mapInArrow(probe, shape)

    gone = _routed_drops(line_digests(rows.select("doc_id", "text"), min_chars), arrays, n_shards)
    per_row = gone.groupBy("doc_id").agg(F.collect_set(F.struct(*DIGEST.names)).alias("gone"))
    joined = rows.alias("r").join(per_row.alias("g"), F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            lists = [{(g["place"], g["print"]) for g in row or ()} for row in piece["gone"].to_pylist()]

            def decide(keys, owner, lists=lists):
                signed = zip(keys["place"].astype(np.int64), keys["print"].astype(np.int64), strict=True)
                return np.array([k in lists[o] for k, o in zip(signed, owner, strict=True)], bool)

            yield _cut(piece, min_chars, decide)

    return joined.select("r.*", "g.gone").mapInArrow(cut, shape)


def _routed_drops(digests: DataFrame, arrays: DataFrame, n_shards: int) -> DataFrame:
    """``doc_id, place, print`` to drop: digests meet their shard's arrays in salted groups."""
    digests = digests.withColumn("shard", _shard(n_shards))
    fullest = digests.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    salts = -(-fullest // GROUP_PROBES) or 1
    probes = digests.withColumn("salt", F.pmod(F.xxhash64("doc_id", "place"), F.lit(salts)).cast("int"))
    copies = arrays.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def probe(keys: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", *DIGEST.names]
        if keys.empty or shard.empty:
            return keys[names].head(0)
        row = shard.iloc[0]
        held = Shard(*(row[n] for n in ("sizes", "bits", "prints", "counts", "keepers")))
        packed = np.empty(len(keys), DIGEST)
        for name in DIGEST.names:
            packed[name] = keys[name].to_numpy().view(np.uint64)
        ids = keys["doc_id"].astype("Int64").fillna(np.iinfo(np.int64).min).to_numpy(np.int64)
        return keys.loc[_drops({int(row["shard"]): held}, n_shards, packed, ids), names]

    by = ["shard", "salt"]
    return probes.groupBy(*by).cogroup(copies.groupBy(*by)).applyInPandas(
        probe, "doc_id long, place long, print long"
    )

"""Jaccard self-join of documents on word shingles, without loss and without listing all pairs.

Sets of equal content are one class. Classes lie in size bands that double; a class also enters the next
band if a partner could lie there. In a band, shingles are dealt to parts by hash. Two linked sets differ
in at most ``k`` shingles, where ``k`` follows from the smaller size, so of ``k + 1`` filled parts one is
the same in both: each class enters the tiles (band, part, content of the part) of its first ``k + 1``
filled parts. A tile thus holds documents that already share a whole part.

The classes of a tile are compared with each other, in blocks where there are many; of a tile with more than a
block of them, each is first compared with the smallest and the greatest id, and the largest component then meets
only the members outside it, never itself. A comparison first bounds the overlap from above with bit counts of
hashed bitmaps (a bit that only one side has is a shingle that the other lacks). Of the pairs whose bound allows a
link, a spanning forest of each block gets its sorted arrays, which are intersected exactly. Blocks that this has
not connected as far as their bounds allow then get the arrays of the members concerned, and all their pairs of
different components are intersected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count  # noqa: F401  a test bounds what is left to count by it

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgewatch.llm.components import components
from edgewatch.llm.rows import keyed_texts, pieces
from edgewatch.llm.word_hash import SPACE_BYTES, mixed, word_hashes
from edgewatch.session import kept_after_scope, materialize, release, scratch_scope

BLOCK = 256
#: Sorted arrays that a block may hold; classes of many shingles make smaller blocks.
BLOCK_BYTES = 4 << 20
BUNDLE_BYTES = 4 << 20
BIT_COLUMNS = 4096
BROADCAST_ROWS = 200_000
SETS = "doc_id long, n long, high long, low long, tiles array<bigint>, bitmap binary"


# --- sets --------------------------------------------------------------------------------------


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    hashes, counts = word_hashes(texts, ~SPACE_BYTES)
    rolled = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for i in range(words):
        rolled = mixed(rolled + hashes[i : i + len(rolled)])
    out, start = [], 0
    for n in counts.tolist():
        if n >= words:
            own = np.sort(rolled[start : start + n - words + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            one = np.zeros(1, np.uint64)
            for h in hashes[start : start + n]:
                one = mixed(one + h)
            out.append(mixed(one + np.uint64(n)))
        else:
            out.append(hashes[:0])
        start += n
    return out


class Limit:
    """A similarity limit ``percent`` as exact integers."""

    def __init__(self, percent: int):
        self.percent = percent

    def most_different(self, size: int) -> int:
        """Shingles in which a set of this size and a linked set that is not smaller can differ."""
        return (100 - self.percent) * size // self.percent

    def linked(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)

    def needed(self, a, b):
        """Least number of common shingles of linked sets."""
        return -(-self.percent * (a + b) // (100 + self.percent))


def tiles(shingles: np.ndarray, limit: Limit) -> np.ndarray:
    """Tile numbers of a set; none for a set that only equal sets can link with."""
    size = len(shingles)
    k = limit.most_different(size)
    if not k:
        return np.empty(0, np.uint64)
    band = size.bit_length()
    bands = [band] + ([band + 1] if 100 * size >= limit.percent << band else [])
    return np.concatenate([_band_tiles(shingles, b, k, limit) for b in bands])


def _band_tiles(shingles: np.ndarray, band: int, k: int, limit: Limit) -> np.ndarray:
    n_parts = 5 * (limit.most_different((1 << band) - 1) + 1) // 4 + 4
    part = ((mixed(shingles + np.uint64(band)) >> np.uint64(32)) % np.uint64(n_parts)).astype(np.int64)
    sums = np.zeros(n_parts, np.uint64)
    np.add.at(sums, part, mixed(shingles))
    filled = np.flatnonzero(np.bincount(part, minlength=n_parts))
    # too few filled parts: then all parts count, the empty ones as well
    used = filled[: k + 1] if len(filled) > k else np.arange(n_parts)
    return mixed(sums[used] + mixed(used.astype(np.uint64) + np.uint64(band << 32)))


def document_sets(docs: DataFrame, words: int, limit: Limit) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = shingle_sets([t or b"" for t in piece["text"].to_pylist()], words)
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s) for s in sets), np.int64).reshape(-1, 2)
            own = [tiles(s, limit).view(np.int64) for s in sets]
            ends = np.concatenate(([0], np.cumsum([len(o) for o in own])))
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(own)))
            sizes = pa.array([len(s) for s in sets], pa.int64())
            bits = pa.array([bitmap(s).tobytes() if len(o) else None for s, o in zip(sets, own, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], sizes, pa.array(digests[:, 0]), pa.array(digests[:, 1]), listed, bits],
                ["doc_id", "n", "high", "low", "tiles", "bitmap"],
            )

    return docs.mapInArrow(build, SETS)


# --- comparing ---------------------------------------------------------------------------------


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """A bit per hash, in about four bits a shingle; the length is a power of two words."""
    n_bits = max(64, 1 << (4 * len(shingles) - 1).bit_length())
    bits = np.zeros(n_bits, bool)
    bits[(shingles & np.uint64(n_bits - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def overlap_bound(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int) -> int:
    """No more shingles can be common to two sets with these bitmaps."""
    words = min(len(a), len(b))
    a, b = _folded(a, words), _folded(b, words)
    return min(size_a - int(np.bitwise_count(a & ~b).sum()), size_b - int(np.bitwise_count(b & ~a).sum()))


def common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))


def sets_of_ids(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id, n, shingles`` of the documents in ``ids``, computed from their texts again."""
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    wanted = docs.join(ids, docs["doc_id"] == ids["id"], "left_semi")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = shingle_sets([t or b"" for t in piece["text"].to_pylist()], words)
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                ["id", "n", "shingles"],
            )

    built = materialize(wanted.mapInArrow(build, "id long, n long, shingles binary"), "shingles")
    if built.groupBy("id").count().filter("count > 1").isEmpty():
        return built
    once = materialize(built.dropDuplicates(["id", "shingles"]), "shingles")
    release(built)
    return once


def _sides(pairs: DataFrame, own: DataFrame, kind: str) -> DataFrame:
    """``pairs`` with ``kind`` and ``n`` of both ends."""
    for end in ("a", "b"):
        names = {"id": end, "n": f"n_{end}", kind: f"{kind}_{end}"}
        pairs = pairs.join(own.select(*(F.col(k).alias(v) for k, v in names.items())), end)
    return pairs


def possible_pairs(pairs: DataFrame, bitmaps: DataFrame, limit: Limit) -> DataFrame:
    """The pairs ``a, b`` whose bitmaps do not rule out a link."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("bitmap_a", "n_a", "bitmap_b", "n_b")), strict=True)
            keep = [
                min(i, j) >= limit.needed(i, j)
                and overlap_bound(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), i, j) >= limit.needed(i, j)
                for x, i, y, j in rows
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _sides(pairs, bitmaps, "bitmap").mapInArrow(bound, "a long, b long").distinct()


def verified_pairs(pairs: DataFrame, docs: DataFrame, words: int, limit: Limit) -> DataFrame:
    """The pairs that are linked, by exact intersection of their sorted arrays."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    arrays = sets_of_ids(docs, materialize(ids, "pair-ids"), words)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("shingles_a", "shingles_b"))
            sets = ((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(*columns, strict=True))
            keep = [limit.linked(common(x, y), len(x), len(y)) for x, y in sets]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _sides(pairs, arrays, "shingles").mapInArrow(verify, "a long, b long")


def dealt_blocks(members: DataFrame, block: int | None = None) -> DataFrame:
    """``tile, row, col, id, component``: members of split tiles (``tile, id, component``) in pairs of blocks.

    A tile that fits a block is one group. Of others, the members outside a tile's largest component are dealt
    to outer blocks by hash, those inside it to inner blocks. Outer blocks meet all blocks, inner ones only outer
    blocks, so a tile of which all but a few members are connected gives few rows more than it has members. With
    a column ``n``, which is passed on, blocks hold at most ``BLOCK_BYTES`` of shingles.
    """
    sized = ["n"] if "n" in members.columns else []
    sizes = members.groupBy("tile", "component").agg(
        F.count(F.lit(1)).alias("held"), *(F.max(c).alias("widest") for c in sized)
    )
    blocks = sizes.groupBy("tile").agg(
        F.max_by("component", F.struct("held", "component")).alias("main"), F.max("held").alias("inside"),
        F.sum("held").alias("all"), *(F.max("widest").alias("widest") for _ in sized),
    )
    limit = F.lit(block or BLOCK)
    if sized:
        limit = F.greatest(F.lit(2), F.least(limit, F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("widest")))))
    one = F.col("all") <= limit
    blocks = blocks.select(
        "tile", "main", F.when(one, 1).otherwise(F.ceil((F.col("all") - F.col("inside")) / limit)).cast("int").alias("outer"),
        F.when(one, 0).otherwise(F.ceil(F.col("inside") / limit)).cast("int").alias("inner"),
    )
    placed = F.xxhash64("id", "tile")
    in_main = (F.col("component") == F.col("main")) & (F.col("inner") > 0)
    own = F.when(in_main, F.col("outer") + F.pmod(placed, F.greatest("inner", F.lit(1)))).otherwise(F.pmod(placed, F.col("outer")))
    others = F.when(in_main, F.col("outer")).otherwise(F.col("outer") + F.col("inner"))
    kept = ["id", "component", *sized]
    dealt = members.join(blocks, "tile").select("tile", *kept, own.cast("int").alias("own"), others.alias("others"))
    every = F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other")
    return dealt.select("tile", "own", every, *kept).select(
        "tile", F.least("own", "other").alias("row"), F.greatest("own", "other").alias("col"), *kept
    )


def allowed_pairs(bits: list[np.ndarray], sizes: np.ndarray, limit: Limit) -> np.ndarray:
    """For all members of a group, which two could be linked by their bitmaps; counts are products of the bits."""
    words = min(map(len, bits))
    bits = np.unpackbits(np.stack([_folded(b, words) for b in bits]).view(np.uint8), axis=1)
    both = np.zeros((len(bits), len(bits)), np.float32)
    for start in range(0, bits.shape[1], BIT_COLUMNS):
        part = bits[:, start : start + BIT_COLUMNS].astype(np.float32)
        both += part @ part.T
    common_at_most = (sizes - np.count_nonzero(bits, axis=1))[:, None] + both.astype(np.int64)
    return np.minimum(common_at_most, common_at_most.T) >= limit.needed(sizes[:, None], sizes)


def _groups_in(frame: pd.DataFrame) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """The leaves of a bundle, each with its columns."""
    frame = frame.sort_values("leaf", kind="stable", ignore_index=True)
    leaf = frame["leaf"].to_numpy()
    ends = np.flatnonzero(np.concatenate((leaf[1:] != leaf[:-1], [True]))) + 1
    columns = {c: frame[c].to_numpy() for c in frame.columns}
    for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        yield int(leaf[start]), {c: v[start:end] for c, v in columns.items()}


def _forest(
    allowed: np.ndarray, roots: np.ndarray, test=lambda i, j: True
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs of members of different components that are allowed, pass the test and connect what such pairs can.

    Also the components that they leave.
    """
    roots, found = roots.copy(), []
    for i in range(len(roots) - 1):
        rest = i + 1 + np.flatnonzero(allowed[i, i + 1 :])
        for j in rest[roots[rest] != roots[i]].tolist():
            if roots[j] != roots[i] and test(i, j):
                found.append((i, j))
                roots[roots == roots[j]] = roots[i]
    return found, roots


def _bundled(leaves: DataFrame, size: int):
    """Leaves in groups of about ``BUNDLE_BYTES``; a leaf is bounded, and never cut."""
    return leaves.withColumn("bundle", F.pmod(F.xxhash64("leaf"), F.lit(max(1, -(-size // BUNDLE_BYTES))))).groupBy("bundle")


def possible_in_blocks(members: DataFrame, bitmaps: DataFrame, limit: Limit) -> DataFrame:
    """``leaf, part, id, other``: in each pair of blocks, a spanning forest of the pairs that could be linked.

    ``members`` has ``tile, id, component, n``. A member that could be linked with one of another component
    is also there with itself. No members of different parts of a leaf could be linked.
    """
    dealt = dealt_blocks(members).select(F.xxhash64("tile", "row", "col").alias("leaf"), "id", "component", "n")
    dealt = materialize(dealt, "dealt")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for leaf, own in _groups_in(frame):
            allowed = allowed_pairs([np.frombuffer(b, np.uint64) for b in own["bitmap"]], own["n"], limit)
            allowed &= own["component"][:, None] != own["component"]
            met = np.flatnonzero(allowed.any(axis=1))
            if len(met):
                ids = own["id"].tolist()
                pairs, parts = _forest(allowed, own["component"])
                found += [(leaf, parts[i], ids[i], ids[j]) for i, j in [*zip(met, met, strict=True), *pairs]]
        return pd.DataFrame(found, columns=["leaf", "part", "id", "other"], dtype="int64")

    size = dealt.agg(F.sum("n").alias("n")).first()["n"] or 0
    shown = dealt.join(bitmaps.select("id", "bitmap"), "id")
    found = materialize(_bundled(shown, size).applyInPandas(compare, "leaf long, part long, id long, other long"), "possible")
    release(dealt)
    return found


def links_in_blocks(members: DataFrame, docs: DataFrame, words: int, limit: Limit) -> DataFrame:
    """``a, b``: links that connect the components in each group of ``members`` (``leaf, id, component``) as far as links do."""
    arrays = sets_of_ids(docs, materialize(members.select("id").distinct(), "block-ids"), words)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, own in _groups_in(frame):
            sets = [np.frombuffer(s, np.uint64) for s in own["shingles"]]
            allowed = allowed_pairs([bitmap(s) for s in sets], own["n"], limit)
            linked, _ = _forest(
                allowed, own["component"], lambda i, j: limit.linked(common(sets[i], sets[j]), len(sets[i]), len(sets[j]))
            )
            found += [(own["id"][i], own["id"][j]) for i, j in linked]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    filled = members.join(arrays, "id")
    size = filled.agg(F.sum("n").alias("n")).first()["n"] or 0
    links = materialize(_bundled(filled, 8 * size).applyInPandas(compare, "a long, b long").distinct(), "links")
    release(arrays)
    return links


# --- the join ----------------------------------------------------------------------------------


def near_duplicate_groups(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: groups of documents that links connect.

    Words are what white space separates, A-Z lower-cased. Two documents link when their sets of
    distinct ``words``-word shingles have a Jaccard similarity of ``percent`` / 100 or more; a document
    with fewer words has one shingle, null, empty and blank texts have none and link with nothing.
    ``component_id`` is the smallest id that links reach, itself included. Repeated rows are copies; ids
    with several texts are not expected, their rows get the component of their own text. Rows with a null
    id have no component and connect nothing.
    """
    limit = Limit(percent)
    texts = keyed_texts(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    sets = document_sets(texts, words, limit).withColumn("row", F.monotonically_increasing_id())
    alike = ["high", "low", "n"]
    with scratch_scope(docs.sparkSession):
        sets = materialize(sets, "sets")
        filled = sets.filter("n > 0 AND doc_id IS NOT NULL")
        classes = filled.groupBy(*alike).agg(F.min("doc_id").alias("id"), F.min_by("row", "doc_id").alias("row"))
        classes = materialize(classes, "classes")
        groups = _linked_classes(filled, classes, texts, words, limit)
        of_class = classes.join(groups, F.col("id") == F.col("a"), "left").select(
            *alike, F.coalesce("b", "id").alias("component_id")
        )
        result = sets.drop("tiles", "row").join(of_class, alike, "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        result = result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
        return kept_after_scope(result, "groups")


def _linked_classes(filled: DataFrame, classes: DataFrame, texts: DataFrame, words: int, limit: Limit) -> DataFrame:
    """``a, b``: classes by their ids and the least class that links reach from them, itself left out."""
    # all members of a class have the same tiles; one row of it enters them, however often it is repeated
    entering = filled.filter("size(tiles) > 0").join(classes.select("id", "row"), "row")
    entering = materialize(entering.select("id", "n", "tiles", "bitmap"), "entering")
    held = entering.select("id", F.explode("tiles").alias("tile"))
    met = held.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("tile"))).filter("members > 1")
    met = materialize(met.select("tile", "id"), "shared-tiles")
    inside = materialize(_distinct_tiles(met), "tile-members")
    release(met)
    # what hangs together in a tile of many blocks is mostly found by its ends, and then need not meet itself
    ends = inside.filter(F.col("members") > BLOCK).select("id", F.explode(F.array("least", "most")).alias("other"))
    stars = _ordered(ends.filter("id != other"))
    groups = _with_links(None, materialize(possible_pairs(stars, entering, limit), "possible"), texts, words, limit)
    split = _still_split(inside.select("tile", "id"), groups).join(entering.select("id", "n"), "id")
    split = materialize(split, "split-tiles")
    possible = possible_in_blocks(split, entering, limit)
    release(split)
    groups = _with_links(groups, _ordered(possible.filter("id != other")), texts, words, limit)
    left = remaining_parts(possible, groups)
    if left.isEmpty():
        return groups
    links = links_in_blocks(left, texts, words, limit)
    return groups if links.isEmpty() else components(groups.unionByName(links))


def remaining_parts(possible: DataFrame, groups: DataFrame) -> DataFrame:
    """``leaf, id, component``: parts of blocks that may hold links no forest has shown, of equal ones one.

    The forest of two members is their only pair.
    """
    parts = possible.filter("id = other").select(F.xxhash64("leaf", "part").alias("tile"), "id").distinct()
    split = materialize(_still_split(parts, groups), "split-parts")
    once = _distinct_tiles(split.select("tile", "id")).filter("members > 2").select("tile", "id")
    left = once.join(split, ["tile", "id"]).select(F.col("tile").alias("leaf"), "id", "component")
    return materialize(left, "split-blocks")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def _with_links(groups: DataFrame | None, pairs: DataFrame, texts: DataFrame, words: int, limit: Limit) -> DataFrame:
    """Components of the groups and those of ``pairs`` that are links."""
    links = materialize(verified_pairs(materialize(pairs, "pairs"), texts, words, limit), "links")
    return components(links if groups is None else groups.unionByName(links))


def _distinct_tiles(inside: DataFrame) -> DataFrame:
    """``tile, id, members, least, most``; of tiles with the same members one stays."""
    content = inside.groupBy("tile").agg(
        F.count(F.lit(1)).alias("members"),
        F.min("id").alias("least"),
        F.max("id").alias("most"),
        F.sum(F.xxhash64("id") % (1 << 31)).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"),
    )
    one = content.groupBy("members", "least", "most", "x", "y").agg(F.min("tile").alias("tile")).drop("x", "y")
    return inside.join(one, "tile")


def _still_split(members: DataFrame, groups: DataFrame) -> DataFrame:
    """``members`` with their ``component``, of the tiles that hold more than one."""
    named = members.join(groups, F.col("id") == F.col("a"), "left")
    named = named.select("tile", "id", F.coalesce("b", "id").alias("component"))
    split = named.groupBy("tile").agg(F.min("component").alias("first"), F.max("component").alias("last"))
    return named.join(split.filter("first != last").select("tile"), "tile")

"""Near duplicates by an LSH forest: sorted orders of min-hash labels, neighbours compared exactly.

Sets of equal content are one class. Every class has a label in each of several trees: a sequence of
min-hash values of its shingles. Each tree is one sorted order of all labels, kept by Spark as range
sorted slices. Labels that share their first ``base`` values are one region of the order; the classes of a
small region are one leaf. A larger region is cut at the depth that it needs, where the longest common
prefixes of neighbours are shorter, until its leaves are small; the neighbours on both sides of a cut stay
candidates. Members of a leaf that are not yet connected are first compared by all their min-hash values;
those with a partner that could be similar enough are then compared exactly on their full sets.

The first tree goes alone and joins most copies; each further round takes as many trees as all before it. In
its orders every class carries its component so far, and a leaf that lies in one component is left behind
where it is cut.

Deep cuts may part linked documents in all orders. So where a region was cut and has not become one
component, its members outside the largest component are compared with all the others, in blocks. The
members of very large regions of that kind first enter a forest of longer labels and more trees.

In every forest the base depth and the number of trees keep the chance to miss a link at the least
similarity of 0.85 below 3 in 10 million, for pairs that no other chain of links connects; the comparison by
min-hash values adds less than 1 in 10 million.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewatch.llm.components import components
from edgewatch.llm.rows import keyed_texts, pieces
from edgewatch.llm.shingle_join import Limit, common, dealt_blocks, shingle_sets
from edgewatch.llm.word_hash import mixed
from edgewatch.session import materialize, release


@dataclass(frozen=True)
class Forest:
    """Neighbours need ``base`` common values; ``depth`` is the length of a label."""

    base: int
    depth: int
    trees: int

    def missed(self, similarity: float) -> float:
        """Chance that no order brings two sets of this similarity together at the base depth."""
        return (1 - similarity**self.base) ** self.trees

    def factors(self) -> np.ndarray:
        """An odd multiplier for each value of each label; products order the hashes anew."""
        rng = np.random.default_rng([2_024, self.base, self.depth, self.trees])
        return rng.integers(0, 2**64, self.trees * self.depth, dtype=np.uint64) | np.uint64(1)


FORESTS = (Forest(3, 8, 16), Forest(8, 14, 48), Forest(16, 24, 208))
LEAF = 256
#: Members from which a cut region enters the next forest.
LARGE_REGION = 50_000
#: Values of a signature, which are those of the first trees' labels.
SIGNATURE = 128
BROADCAST_ROWS = 200_000
#: Members of a parted region in a block; two blocks with their signatures and sets are one task's work.
REGION_BLOCK = 1024
SLICE_ROWS = 200_000
BUNDLE_BYTES = 4 << 20
CELLS = 1 << 18
SETS = "doc_id long, n long, high long, low long, labels binary"
ORDERED = "leaf long, region long, id long, root long, open boolean, border long, tree int, label binary"


# --- labels ------------------------------------------------------------------------------------


def labels_of(shingles: np.ndarray, factors: np.ndarray) -> bytes:
    """16-bit values, each from the least product of a shingle hash with its factor; empty sets have none."""
    if not len(shingles):
        return b""
    width = max(CELLS // len(factors), 1)
    least = np.full(len(factors), 2**64 - 1, np.uint64)
    for start in range(0, len(shingles), width):
        np.minimum(least, (factors[:, None] * shingles[None, start : start + width]).min(axis=1), out=least)
    return mixed(least).astype(">u2").tobytes()


def _built(docs: DataFrame, words: int, schema: str, last) -> DataFrame:
    """Size and digest of every text's set, and ``last(set)``. ``docs`` has ``doc_id, text``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = shingle_sets([t or b"" for t in piece["text"].to_pylist()], words)
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s) for s in sets), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]),
                 pa.array(digests[:, 1]), pa.array([last(s) for s in sets], pa.binary())],
                [part.split()[0] for part in schema.split(", ")],
            )

    return docs.mapInArrow(build, schema)


def labelled_sets(docs: DataFrame, words: int, forest: Forest) -> DataFrame:
    factors = forest.factors()
    return _built(docs, words, SETS, lambda s: labels_of(s, factors))


def _texts_of(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``texts`` with an id of ``classes``, a stored table."""
    return texts.join(_small(classes.select("doc_id")), "doc_id", "left_semi")


# --- sorted orders -----------------------------------------------------------------------------


def cut_order(tree: np.ndarray, values: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows in order: first row of the leaf, whether the region was cut, values shared with the row before."""
    n = len(tree)
    at = np.arange(n)
    shared = np.zeros(n, np.int64)
    equal = (values[1:] == values[:-1]) & (tree[1:] == tree[:-1])[:, None]
    shared[1:] = np.cumprod(equal, axis=1).sum(axis=1)
    leaf, dense = np.full(n, -1), np.zeros(n, bool)
    for depth in range(forest.base, forest.depth + 1):
        breaks = shared < depth
        start = np.maximum.accumulate(np.where(breaks, at, 0))
        large = np.bincount(start, minlength=n)[start] > LEAF
        if depth == forest.base:
            dense = large
        mine = (leaf < 0) & ~large
        leaf[mine] = start[mine]
    rest = leaf < 0  # as alike as labels can tell: neighbours in steps of a leaf
    leaf[rest] = start[rest] + (at[rest] - start[rest]) // LEAF * LEAF
    return leaf, dense, shared


def region_of(tree: np.ndarray, values: np.ndarray, base: int) -> np.ndarray:
    key = mixed(tree.astype(np.uint64) + np.uint64(base << 32))
    for column in values[:, :base].T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def _leaves(tree, label, ids, forest: Forest, number: int, borders: bool, roots=None) -> pd.DataFrame:
    """Rows of the leaves in one slice of the order, and those that touch its borders.

    ``roots`` are the components so far, at first the ids. A leaf is open if it holds more than one; rows of
    others are there for their region only, and without one not at all.
    """
    roots = ids if roots is None else roots
    values = np.frombuffer(b"".join(label), ">u2").reshape(len(label), -1).astype(np.uint64)
    leaf, dense, shared = cut_order(tree, values, forest)
    region = region_of(tree, values, forest.base)
    at = np.arange(len(tree))
    # a leaf is named by its first row and ends where the next one begins
    several = np.zeros(len(tree), bool)
    several[leaf[1:][(leaf[1:] == leaf[:-1]) & (roots[1:] != roots[:-1])]] = True
    several = several[leaf]
    taken = dense | several
    # both sides of a cut inside a region are neighbours, too
    cut = at[1:][(leaf[1:] != leaf[:-1]) & (shared[1:] >= forest.base) & (roots[1:] != roots[:-1])]
    sides = np.ones(len(cut), bool)
    rows = [(leaf[taken] * 2, at[taken], several[taken]), (cut * 2 + 1, cut - 1, sides), (cut * 2 + 1, cut, sides)]
    parts = [
        {"leaf": (number << 34) + key, "row": row, "region": np.where(dense[row], region[row], 0), "open": held, "border": -1}
        for key, row, held in rows
    ]
    if borders and len(at):
        near = shared >= forest.base
        head = at[: LEAF][np.cumprod(np.concatenate(([True], near[1:LEAF]))).astype(bool)]
        tail = at[::-1][:LEAF][np.cumprod(np.concatenate(([True], near[:0:-1][: LEAF - 1]))).astype(bool)]
        for row, border in ((head, number), (tail, number + 1)):
            none = {"leaf": np.full(len(row), -1), "region": np.zeros(len(row), np.int64), "open": np.zeros(len(row), bool)}
            parts.append({**none, "row": row, "border": border})
    frame = pd.concat([pd.DataFrame(p) for p in parts])
    row = frame.pop("row").to_numpy()
    at_border = (frame["border"] >= 0).to_numpy()
    names = [x if b else None for x, b in zip(np.asarray(label, object)[row], at_border, strict=True)]
    return frame.assign(id=ids[row], root=roots[row], tree=tree[row].astype(np.int32), label=names)[
        ["leaf", "region", "id", "root", "open", "border", "tree", "label"]
    ]


def sorted_leaves(labelled: DataFrame, forest: Forest, trees: range | None = None) -> DataFrame:
    """``tree, leaf, region, id, root, open``: leaves of the orders; ``region`` is 0 where the base depth was enough.

    ``labelled`` is a stored table of ``id``, the ``labels`` of these trees and, if there are components, ``root``.
    A slice is a contiguous part of all orders; what lies at its ends is looked at again together with the end
    of the next slice. Only open leaves hold more than one component.
    """
    width, trees = 2 * forest.depth, trees or range(forest.trees)
    slices = max(1, -(-labelled.count() * len(trees) // SLICE_ROWS))
    if "root" not in labelled.columns:
        labelled = labelled.withColumn("root", F.col("id"))
    every = F.explode(F.sequence(F.lit(trees[0]), F.lit(trees[-1]))).alias("tree")
    rows = labelled.select("id", "root", "labels", every)
    rows = rows.select("tree", F.expr(f"substring(labels, (tree - {trees[0]}) * {width} + 1, {width})").alias("label"), "id", "root")
    keys = ("tree", "label", "id")
    ordered = rows.repartitionByRange(slices, *keys).sortWithinPartitions(*keys)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            tree, ids, roots = (table[c].to_numpy() for c in ("tree", "id", "root"))
            found = _leaves(tree, table["label"].to_pylist(), ids, forest, TaskContext.get().partitionId(), True, roots)
            yield from pa.Table.from_pandas(found, leaf_schema, preserve_index=False).to_batches(1 << 16)

    leaf_schema = pa.schema(
        [("leaf", pa.int64()), ("region", pa.int64()), ("id", pa.int64()), ("root", pa.int64()), ("open", pa.bool_()),
         ("border", pa.int64()), ("tree", pa.int32()), ("label", pa.binary())]
    )
    found = materialize(ordered.mapInArrow(cut, ORDERED), "order")

    def mend(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["tree", "label", "id"])
        label = [bytes(x) for x in frame["label"]]
        number = -1 - int(frame["border"].iloc[0])
        tree, ids, roots = (frame[c].to_numpy() for c in ("tree", "id", "root"))
        return _leaves(tree, label, ids, forest, number, False, roots)

    columns = ["tree", "leaf", "region", "id", "root", "open"]
    borders = found.filter("border >= 0").groupBy("border").applyInPandas(mend, ORDERED)
    inside = found.filter("border < 0").select(*columns)
    out = materialize(inside.unionByName(borders.select(*columns)), "leaves")
    release(found)
    return out


# --- comparing ---------------------------------------------------------------------------------


def links_in_leaf(ids: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], limit: Limit) -> list[tuple[int, int]]:
    """Links that connect the members as far as links do; pairs that are connected are not compared.

    A pair is first bounded by bit maps: a bit that only one side has is a shingle that the other lacks.
    """
    sizes = np.array([len(s) for s in sets])
    bits = max(64, 1 << (4 * int(sizes.max()) - 1).bit_length())
    maps = np.zeros((len(sets), bits), bool)
    for row, s in zip(maps, sets, strict=True):
        row[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    maps = np.packbits(maps, axis=1).view(np.uint64)
    roots, found = roots.copy(), []
    for i in range(len(sets) - 1):
        rest = np.arange(i + 1, len(sets))
        rest = rest[roots[rest] != roots[i]]
        needed = limit.needed(sizes[rest], sizes[i])
        mine = sizes[i] - np.bitwise_count(maps[i] & ~maps[rest]).sum(axis=1, dtype=np.int64)
        theirs = sizes[rest] - np.bitwise_count(maps[rest] & ~maps[i]).sum(axis=1, dtype=np.int64)
        for j in rest[np.minimum(mine, theirs) >= needed].tolist():
            if roots[j] != roots[i] and limit.linked(common(sets[i], sets[j]), len(sets[i]), len(sets[j])):
                found.append((int(ids[i]), int(ids[j])))
                roots[roots == roots[j]] = roots[i]
    return found


def least_agreement(percent: int, values: int = SIGNATURE, risk: float = 1e-7) -> int:
    """Common values that two sets of this similarity reach, but for a chance of less than ``risk``."""
    p, below = percent / 100, 0.0
    for k in range(values + 1):
        below += comb(values, k) * p**k * (1 - p) ** (values - k)
        if below > risk:
            return k
    return values


def possible_members(roots: np.ndarray, signatures: np.ndarray, agreement: int) -> np.ndarray:
    """Which members of a leaf agree in so many values with a member of another component."""
    kept = np.zeros(len(roots), bool)
    for i in range(len(roots) - 1):
        near = np.count_nonzero(signatures[i + 1 :] == signatures[i], axis=1) >= agreement
        near &= roots[i + 1 :] != roots[i]
        if near.any():
            kept[i] = True
            kept[i + 1 :] |= near
    return kept


def _small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if its rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def leaf_links(
    members: DataFrame, signatures: DataFrame, classes: DataFrame, texts: DataFrame, words: int, limit: Limit
) -> DataFrame | None:
    """``a, b``: links inside the leaves of ``members`` that join components, or None.

    ``members`` is a stored table of ``leaf, id, root``. The leaves in which no two members can be linked are
    left behind with their signatures; only the rest get their sets, made from the texts again.
    """

    def narrow(frame: pd.DataFrame) -> pd.DataFrame:
        kept, agreement = [], least_agreement(limit.percent, len(frame["signature"].iloc[0]) // 2)
        for _, own in frame.groupby("leaf", sort=False):
            values = np.frombuffer(b"".join(own["signature"]), np.uint16).reshape(len(own), -1)
            kept.append(own.loc[possible_members(own["root"].to_numpy(), values, agreement), ["leaf", "id", "root"]])
        return pd.concat(kept)

    compared = _bundled(members.join(signatures, "id"), members.count() * 2 * SIGNATURE)
    kept = materialize(compared.applyInPandas(narrow, "leaf long, id long, root long"), "possible")
    if kept.isEmpty():
        return None
    arrays = sets_of(kept, classes, texts, words)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, own in frame.groupby("leaf", sort=False):
            sets = [np.frombuffer(s, np.uint64) for s in own["shingles"]]
            found += links_in_leaf(own["id"].to_numpy(), own["root"].to_numpy(), sets, limit)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    filled = kept.join(arrays, "id")
    size = filled.agg(F.sum("n").alias("n")).first()["n"] or 0
    links = materialize(_bundled(filled, 8 * size).applyInPandas(compare, "a long, b long").distinct(), "links")
    release(kept)
    release(arrays)
    return links


def _bundled(filled: DataFrame, size: int):
    """Leaves in groups of about ``BUNDLE_BYTES``; a leaf is bounded, and never cut."""
    bundles = max(1, -(-size // BUNDLE_BYTES))
    return filled.withColumn("bundle", F.pmod(F.xxhash64("leaf"), F.lit(bundles))).groupBy("bundle")


def sets_of(members: DataFrame, classes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``id, n, shingles`` of the classes in ``members``, each once."""
    alike = ["high", "low", "n"]
    met = materialize(members.select("id").distinct().join(classes, "id"), "met")
    built = _built(_texts_of(texts, met), words, SETS.replace("labels", "shingles"), lambda s: s.tobytes())
    # one row of each class under the class's own id; repeated rows of that id give further ones
    built = built.join(_small(met.select("id", "doc_id", *alike)), ["doc_id", *alike])
    built = built.select("id", "n", "shingles", F.monotonically_increasing_id().alias("copy"))
    stored = materialize(built, "arrays")
    release(met)
    copies = stored.groupBy("id").agg(F.min("copy").alias("copy"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = materialize(copies.select("id", F.col("copy").alias("first")), "copies")
    if copies.isEmpty():
        return stored
    once = stored.join(_small(copies), "id", "left").filter("first IS NULL OR copy = first").drop("first")
    return materialize(once, "arrays")


def distinct_leaves(leaves: DataFrame, earlier: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``leaf, id, root``: the open leaves, of those with the same members one, and none that was there ``earlier``.

    Also the contents of those leaves, a row each.
    """
    held = leaves.filter("open").select("leaf", "id", "root").distinct()
    mixed_id = [F.xxhash64("id", F.lit(seed)) for seed in (1, 2)]
    content = held.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.sum(mixed_id[0] % (1 << 31)).alias("x"),
        F.bit_xor(mixed_id[1]).alias("y"), F.min("id").alias("least"), F.max("id").alias("most"),
    )
    alike = ["n", "x", "y", "least", "most"]
    once = content.groupBy(*alike).agg(F.min("leaf").alias("leaf"))
    once = materialize(once if earlier is None else once.join(earlier, alike, "left_anti"), "contents")
    return materialize(held.join(once.select("leaf"), "leaf"), "distinct-leaves"), once


def rounds(trees: int) -> list[range]:
    """The first tree, then as many as there were before."""
    ends = [0, 1]
    while ends[-1] < trees:
        ends.append(min(2 * ends[-1], trees))
    return [range(start, end) for start, end in zip(ends, ends[1:], strict=False)]


def _joined(groups: DataFrame, links: DataFrame | None) -> DataFrame:
    """Components of the groups and further links."""
    return groups if links is None or links.isEmpty() else components(groups.unionByName(links))


def _with_roots(labelled: DataFrame, groups: DataFrame, forest: Forest, trees: range) -> DataFrame:
    """``id, labels, root``, stored: the classes with the labels of these trees and their components."""
    width = 2 * forest.depth
    own = labelled.select("id", F.substring("labels", trees[0] * width + 1, len(trees) * width).alias("labels"))
    named = own.join(groups, F.col("id") == F.col("a"), "left")
    return materialize(named.select("id", "labels", F.coalesce("b", "id").alias("root")), "rooted")


def parted_regions(leaves: DataFrame, groups: DataFrame) -> DataFrame:
    """``region, id, root`` of the regions that were cut and hold more than one component.

    Components grew since the orders were made, so the roots that a region has there are looked up in
    ``groups``; members are only named in regions that stay parted.
    """
    dense = leaves.filter("region != 0").select("region", "id", F.col("root").alias("was"))
    named = dense.select("region", "was").distinct().join(groups, F.col("was") == F.col("a"), "left")
    named = materialize(named.select("region", "was", F.coalesce("b", "was").alias("root")), "region-roots")
    split = named.groupBy("region").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    parted = named.join(split.filter("least != most").select("region"), "region")
    regions = materialize(dense.join(parted, ["region", "was"]).select("region", "id", "root").distinct(), "regions")
    release(named)
    return regions


def remaining_leaves(regions: DataFrame) -> DataFrame:
    """``leaf, id, root``: the members of parted regions in pairs of blocks, all but those inside one component."""
    members = regions.select(F.col("region").alias("tile"), "id", F.col("root").alias("component"))
    blocks = dealt_blocks(members, REGION_BLOCK)
    named = blocks.select(F.xxhash64("tile", "row", "col").alias("leaf"), "id", F.col("component").alias("root")).distinct()
    split = named.groupBy("leaf").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    return materialize(named.join(split.filter("least != most").select("leaf"), "leaf"), "live-leaves")


# --- groups ------------------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
    forests: tuple[Forest, ...] = FORESTS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: groups of documents that links connect.

    Words are what white space separates, A-Z lower-cased. Two documents link when their sets of distinct
    ``words``-word shingles have a Jaccard similarity of ``percent`` / 100 or more, confirmed on the full
    sets; a document with fewer words has one shingle, null, empty and blank texts have none and link with
    nothing. ``component_id`` is the smallest id that links reach, itself included; ``kept`` marks the
    rows that have it. Repeated rows are copies of each other; rows of one id with different texts belong
    to the components of their own texts. Rows with a null id connect nothing and have a null component.
    The default forests are made for similarities of 0.85 or more; see ``Forest.missed`` for others.
    """
    limit = Limit(percent)
    texts = keyed_texts(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    sets = labelled_sets(texts, words, forests[0]).withColumn("row", F.monotonically_increasing_id())
    sets = materialize(sets, "sets")
    alike = ["high", "low", "n"]
    filled = sets.filter("n > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy(*alike).agg(F.min("doc_id").alias("doc_id"), F.min_by("row", "doc_id").alias("id"))
    classes = materialize(classes, "classes")
    labelled = filled.select("row", "labels").join(classes.select(F.col("id").alias("row")), "row")
    labelled = materialize(labelled.select(F.col("row").alias("id"), "labels"), "labels")
    signatures = labelled.select("id", F.substring("labels", 1, 2 * SIGNATURE).alias("signature"))
    groups = sets.sparkSession.createDataFrame([], "a long, b long")
    for number, forest in enumerate(forests):
        orders, earlier = [], None
        for trees in rounds(forest.trees):
            rooted = _with_roots(labelled, groups, forest, trees)
            orders.append(sorted_leaves(rooted, forest, trees))
            release(rooted)
            members, contents = distinct_leaves(orders[-1], earlier)
            earlier = contents if earlier is None else earlier.unionByName(contents)
            groups = _joined(groups, leaf_links(members, signatures, classes, texts, words, limit))
            release(members)
        regions = parted_regions(reduce(DataFrame.unionByName, orders), groups)
        for order in orders:
            release(order)
        if regions.isEmpty():
            break
        sizes = regions.groupBy("region").agg(F.count(F.lit(1)).alias("members"))
        large = sizes.filter(F.col("members") > (LARGE_REGION if number < len(forests) - 1 else 2**62)).select("region")
        large = materialize(large, "large-regions")
        rest = remaining_leaves(regions.join(_small(large), "region", "left_anti"))
        groups = _joined(groups, leaf_links(rest, signatures, classes, texts, words, limit))
        release(rest)
        if large.isEmpty():
            break
        inside = regions.join(_small(large), "region", "left_semi").select("id").distinct().join(classes, "id")
        inside = materialize(inside, "inside")
        again = labelled_sets(_texts_of(texts, inside), words, forests[number + 1])
        again = again.join(_small(inside.select("id", "doc_id", *alike)), ["doc_id", *alike])
        labelled = materialize(again.select("id", "labels").distinct(), "labels")
    roots = groups.unionByName(groups.select(F.col("b").alias("a"), "b")).distinct()
    roots = roots.join(classes.select(F.col("id").alias("a"), "doc_id"), "a")
    least = roots.groupBy("b").agg(F.min("doc_id").alias("component_id"))
    linked = materialize(roots.join(least, "b").select(F.col("a").alias("id"), "component_id"), "linked")
    of_class = classes.join(linked, "id", "left").select(*alike, F.coalesce("component_id", "doc_id").alias("component_id"))
    result = sets.select("doc_id", *alike).join(of_class, alike, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id") == F.col("component_id")
    )

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgewatch.llm import shingle_join
from edgewatch.llm.components import components

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) or frozenset([tuple(w)])


def _model(rows, words, percent):
    sets = {doc: _set(text, words) for doc, text in rows if doc is not None}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted(
        ((doc, len(_set(text, words)), None if doc is None else find(doc)) for doc, text in rows), key=str
    )


def _rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows, next_id = [], iter(rng.sample(range(100_000), 2000))
    for _ in range(30):
        base = rng.choices(vocabulary, k=rng.choice([4, 6, 8, 9, 11, 13, 15, 20, 30, 60, 120, 400]))
        for _ in range(rng.randrange(1, 9)):  # chains of small edits around the limit
            copy = list(base)
            for _ in range(rng.randrange(0, 2 + len(base) // 50)):
                at, kind = rng.randrange(len(copy)), rng.randrange(3)
                copy[at : at + (kind > 0)] = [] if kind == 1 else [rng.choice(vocabulary)]
            rows.append((next(next_id), rng.choice([" ", "\n", "\t "]).join(copy).title()))
            if rng.random() < 0.5:
                base = copy
    common = rng.choices(vocabulary, k=12)
    rows += [(next(next_id), " ".join(common + rng.choices(vocabulary, k=rng.randrange(4)))) for _ in range(40)]
    rows += [(next(next_id), None), (next(next_id), ""), (next(next_id), " \n "), (next(next_id), "one"), (next(next_id), "ONE")]
    rows += [(next(next_id), "same again " * 3000) for _ in range(3)] + [rows[0], (None, rows[1][1])]
    return rows


@pytest.mark.parametrize(("words", "percent", "block"), [(3, 90, 256), (5, 80, 3), (2, 60, 4)])
def test_equals_all_pairs(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    rows = _rows(words)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(3)
    got = shingle_join.near_duplicate_groups(docs, words, percent).collect()
    assert sorted(map(tuple, got), key=str) == _model(rows, words, percent)


def test_repeated_table_with_pairs_just_below_the_limit_ends(spark, monkeypatch):
    def turns():
        yield from range(6)
        raise AssertionError("the same pairs are compared again and again")

    monkeypatch.setattr(shingle_join, "count", turns)
    texts = [" ".join([*(f"w{i}" for i in range(35)), *(f"own{doc}x{i}" for i in range(5))]) for doc in range(12)]
    rows = [*enumerate(texts), (12, texts[11] + " more")]  # 35 of 45 words: 0.78; the last two are linked
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string")
    got = shingle_join.near_duplicate_groups(docs, 1, 80).collect()
    assert sorted(map(tuple, got), key=str) == _model(rows * 2, 1, 80)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert shingle_join.near_duplicate_groups(docs).count() == 0


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_a_tile(percent):
    rng = np.random.default_rng(percent)
    limit = shingle_join.Limit(percent)
    for _ in range(1500):
        size = int(rng.integers(1, 90))
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        keep = a[: size - int(rng.integers(0, 1 + size // 4))]
        b = np.sort(np.concatenate((keep, rng.integers(0, 2**63, int(rng.integers(0, 1 + size // 4))).astype(np.uint64))))
        a = np.sort(a)
        shared = shingle_join.common(a, b) if len(b) else 0
        if len(b) and limit.linked(shared, len(a), len(b)) and shared < max(len(a), len(b)):
            assert set(shingle_join.tiles(a, limit).tolist()) & set(shingle_join.tiles(b, limit).tolist())
            bound = shingle_join.overlap_bound(shingle_join.bitmap(a), shingle_join.bitmap(b), len(a), len(b))
            assert bound >= shared


def test_a_hot_tile_with_one_outsider_gives_few_rows(spark):
    n = 20_000
    ids = spark.range(n + 1).select(F.lit(1).alias("tile"), F.col("id"), (F.col("id") == n).cast("long").alias("component"))
    rows = shingle_join.dealt_blocks(ids)
    assert rows.count() <= n + n // shingle_join.BLOCK + 2
    largest = rows.groupBy("tile", "row", "col").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert largest < 2 * shingle_join.BLOCK


def test_a_tile_that_fits_a_block_is_one_group_of_its_members(spark):
    ids = spark.range(200).select((F.col("id") % 2).alias("tile"), "id", F.col("id").alias("component"))
    rows = shingle_join.dealt_blocks(ids)
    assert rows.count() == 200
    assert rows.select("tile", "row", "col").distinct().count() == 2


def test_blocks_of_long_sets_hold_a_bounded_number_of_shingles(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK_BYTES", 8 * 20_000 * 10)
    ids = spark.range(100).select(F.lit(1).alias("tile"), "id", F.col("id").alias("component"), F.lit(20_000).alias("n"))
    rows = shingle_join.dealt_blocks(ids)
    assert rows.groupBy("tile", "row", "col").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] < 4 * 20_000 * 10


def test_bounds_of_a_group_are_those_of_its_pairs(monkeypatch):
    monkeypatch.setattr(shingle_join, "BIT_COLUMNS", 100)
    rng, limit = np.random.default_rng(4), shingle_join.Limit(80)
    base = rng.integers(0, 2**63, 200).astype(np.uint64)
    sets = [np.sort(rng.choice(base, n, replace=False)) for n in (3, 120, 150, 180, 190, 199, 200)]
    bits, sizes = [shingle_join.bitmap(s) for s in sets], np.array([len(s) for s in sets])
    words = min(map(len, bits))
    short = [shingle_join._folded(b, words) for b in bits]
    allowed = shingle_join.allowed_pairs(bits, sizes, limit)
    for i, a in enumerate(short):
        for j, b in enumerate(short):
            assert allowed[i, j] == (shingle_join.overlap_bound(a, b, sizes[i], sizes[j]) >= limit.needed(sizes[i], sizes[j]))


def test_only_parts_with_an_uncompared_pair_remain_and_equal_ones_once(spark):
    parts = {(1, 1): (1, 2), (2, 1): (3, 4, 5), (3, 1): (3, 4, 5), (4, 1): (6, 7, 8), (4, 2): (3, 5, 9)}
    rows = [(leaf, part, i, i) for (leaf, part), ids in parts.items() for i in ids] + [(2, 1, 3, 4), (1, 1, 1, 2)]
    groups = spark.createDataFrame([(7, 6), (8, 6)], "a long, b long")
    left = shingle_join.remaining_parts(spark.createDataFrame(rows, "leaf long, part long, id long, other long"), groups)
    found = {}
    for r in left.collect():
        found.setdefault(r.leaf, set()).add(r.id)
    assert sorted(map(sorted, found.values())) == [[3, 4, 5], [3, 5, 9]]


def test_every_pair_of_components_meets_in_a_block(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK", 5)
    rng = random.Random(3)
    members = [(t, i, rng.choice([0, 0, 0, 1, 2, i])) for t in range(3) for i in rng.sample(range(100, 200), 40)]
    dealt = shingle_join.dealt_blocks(spark.createDataFrame(members, "tile long, id long, component long"))
    groups = {}
    for r in dealt.collect():
        groups.setdefault((r.tile, r.row, r.col), set()).add(r.id)
    met = {(t, a, b) for (t, _, _), ids in groups.items() for a in ids for b in ids}
    assert all((t, i, j) in met for t, i, c in members for u, j, d in members if t == u and c != d)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(50, 90)] + [(200 + i, 300) for i in range(60)] + [(7, 7)]
    got = {r.a: r.b for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 50 for i in range(51, 91)}, **{200 + i: 200 for i in range(1, 60)}, 300: 200}

"""Groups against all pairs, with forests small enough that every stage is used."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgewatch.llm import minhash_forest as forest
from edgewatch.llm.minhash_forest import Forest, near_duplicates


def shingles(text, words):
    own = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    if len(own) < words:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + words]) for i in range(len(own) - words + 1)}


def plain_groups(rows, words, percent):
    sets = [shingles(text, words) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                if rows[i][0] is not None and rows[j][0] is not None:
                    root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = None if doc_id is None else least[find(i)] if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, None if doc_id is None else doc_id == component))
    return sorted(out, key=str)


def edited(words, rnd, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return words


def corpus(seed, families=12, size=12):
    """Families of copies with few or many edits, and documents that share half of their text."""
    rnd = random.Random(seed)
    texts, notice = [], [f"notice{i}" for i in range(40)]
    for _ in range(families):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(4, 120))]
        texts += [" ".join(edited(base, rnd, rnd.randint(0, 5))) for _ in range(size)]
    texts += [" ".join(notice + [f"w{rnd.randrange(3000)}" for _ in range(12)]) for _ in range(60)]
    return [(i, t) for i, t in enumerate(texts)]


def groups_of(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted(map(tuple, near_duplicates(docs, **options).collect()), key=str)


def test_against_all_pairs(spark):
    rows = corpus(1)
    assert groups_of(spark, rows, words=3, percent=85) == plain_groups(rows, 3, 85)


@pytest.mark.parametrize("large", [5, 1000])
def test_cut_regions_go_through_every_forest(spark, monkeypatch, large):
    monkeypatch.setattr(forest, "LEAF", 4)
    monkeypatch.setattr(forest, "LARGE_REGION", large)
    monkeypatch.setattr(forest, "REGION_BLOCK", 7)
    monkeypatch.setattr(forest, "SLICE_ROWS", 500)
    rows = corpus(2)
    few = (Forest(1, 2, 2), Forest(2, 3, 2))  # too few trees: what they miss is found without labels
    assert groups_of(spark, rows, words=3, percent=85, forests=few) == plain_groups(rows, 3, 85)


def test_leaves_at_slice_borders_are_whole(spark, monkeypatch):
    monkeypatch.setattr(forest, "SLICE_ROWS", 64)
    one = Forest(2, 4, 3)
    rnd = np.random.default_rng(3)
    labels = [rnd.integers(0, 3, 12).astype(">u2").tobytes() for _ in range(200)]
    table = spark.createDataFrame(list(enumerate(map(bytearray, labels))), "id long, labels binary")
    found = {}
    for r in forest.sorted_leaves(table, one).collect():
        found.setdefault((r["tree"], r["leaf"]), set()).add(r["id"])
    together = {(t, frozenset((a, b))) for (t, _), ids in found.items() for a in ids for b in ids if a < b}
    for tree in range(3):
        base = {}
        for i, own in enumerate(labels):
            base.setdefault(own[tree * 8 : tree * 8 + 4], []).append(i)
        for ids in base.values():
            if len(ids) <= forest.LEAF:
                assert all((tree, frozenset((a, b))) in together for a in ids for b in ids if a < b)


def test_one_region_of_near_copies_with_one_outsider_stays_linear(spark):
    """The rows that leaves hold grow with the members, whatever the size of the region."""
    label = np.arange(24, dtype=">u2")
    for n in (500, 2000):
        tree = np.zeros(n, np.int64)
        values = np.tile(label[:8].astype(np.uint64), (n, 1))
        leaves = forest._leaves(tree, [label[:8].tobytes()] * n, np.arange(n), Forest(3, 8, 1), 0, False)
        assert values.shape == (n, 8)
        assert len(leaves) <= 2 * n and leaves.groupby("leaf").size().max() <= forest.LEAF


def test_leaves_of_one_component_are_left_behind():
    rng = np.random.default_rng(4)
    label = np.concatenate([np.full((20, 8), k) for k in range(3)]).astype(">u2")
    roots = np.repeat([0, 20, 40], 20)
    roots[25] = 25
    rows = forest._leaves(np.zeros(60, np.int64), [x.tobytes() for x in label], rng.permutation(60), Forest(3, 8, 1), 0, False, roots)
    assert rows["open"].all() and sorted(rows["root"]) == [20] * 19 + [25]


@pytest.mark.parametrize("trees", [1, 2, 3, 16, 208])
def test_rounds_hold_every_tree_once(trees):
    assert [t for r in forest.rounds(trees) for t in r] == list(range(trees))


def test_near_copies_do_not_meet_in_every_order(spark, monkeypatch):
    """Most trees find their leaves connected: few rows a member are compared, not one for each tree."""
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(3000)}" for _ in range(300)]
    rows = [(i, " ".join(edited(base, rnd, 1))) for i in range(600)] + [(600, "some other text of a few words")]
    compared, whole = [], forest.leaf_links
    monkeypatch.setattr(forest, "leaf_links", lambda *a: compared.append(a[0].count()) or whole(*a))
    assert {r[2] for r in groups_of(spark, rows, words=3, percent=85)} == {0, 600}
    assert sum(compared) < 4 * len(rows)


def test_least_agreement_is_a_safe_bound():
    rng = np.random.default_rng(1)
    agreed = rng.binomial(128, 0.85, 2_000_000)
    assert 70 < forest.least_agreement(85) <= agreed.min() + 2
    assert forest.least_agreement(85, 4) == 0


def test_members_without_a_possible_partner_are_left_behind():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 16, (6, 128)).astype(np.uint16)
    values[3, :100] = values[1, :100]
    values[5] = values[4]
    kept = forest.possible_members(np.array([0, 1, 2, 3, 4, 4]), values, 85)
    assert kept.tolist() == [False, True, False, True, False, False]


def test_forests_keep_their_promise():
    assert all(f.missed(0.85) < 3e-7 for f in forest.FORESTS)


def test_rows_of_every_kind(spark):
    text = "one two three four five six seven"
    rows = [(5, text), (2, text.upper()), (None, text), (2, "other words of the same id here"), (7, None), (8, ""),
            (9, " \n"), (11, "one two"), (10, "ONE two"), (5, text)]
    assert groups_of(spark, rows, words=3, percent=85) == plain_groups(rows, 3, 85)
    none = spark.createDataFrame([], "doc_id long, text string, id long, labels int")
    assert near_duplicates(none).count() == 0


def test_other_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string").select(
        "*", F.lit(1).alias("row"), F.lit(2).alias("high"), F.lit(3).alias("a"), F.lit(4).alias("b")
    )
    assert near_duplicates(docs, words=3, percent=85).collect()[0]["component_id"] == 1


@pytest.mark.parametrize("n", [1, 2, 40, 5000])
def test_label_values_do_not_depend_on_pieces(n, monkeypatch):
    own = np.sort(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    factors = FORESTS[0].factors()
    whole = forest.labels_of(own, factors)
    monkeypatch.setattr(forest, "CELLS", 700)
    assert forest.labels_of(own, factors) == whole


FORESTS = forest.FORESTS

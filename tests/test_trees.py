"""Trees against an exhaustive search over plain lists."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgewatch.functions import ordering
from edgewatch.operators import trees as trees_module
from edgewatch.operators.trees import decision_trees

SCHEMA = "attack_type string, a double, b double, c double"


def best_cut(x, y, min_leaf):
    """Feature, threshold of the purest cut of the rows, or None."""
    n, p = len(y), int(y.sum())
    found = None
    for f in range(x.shape[1]):
        values, place = np.unique(x[:, f], return_inverse=True)
        left = np.cumsum(np.bincount(place, minlength=len(values)))
        hits = np.cumsum(np.bincount(place, weights=y, minlength=len(values))).astype(int)
        for i in range(len(values) - 1):
            nl, pl = int(left[i]), int(hits[i])
            nr, pr = n - nl, p - pl
            if nl < min_leaf or nr < min_leaf or pl * n == p * nl:
                continue
            score = (pl * pl + (nl - pl) ** 2) / nl + (pr * pr + (nr - pr) ** 2) / nr
            if found is None or score > found[0]:
                found = (score, f, (values[i] + values[i + 1]) / 2)
    return found and found[1:]


def plain_tree(x, y, max_depth, min_leaf, number=1, out=None):
    out = {} if out is None else out
    n, p = len(y), int(y.sum())
    out[number] = (n, p, None, None)
    cut = best_cut(x, y, min_leaf) if number.bit_length() <= max_depth and 0 < p < n else None
    if cut:
        f, t = cut
        out[number] = (n, p, "abc"[f], t)
        for side, rows in enumerate((x[:, f] <= t, x[:, f] > t)):
            plain_tree(x[rows], y[rows], max_depth, min_leaf, 2 * number + side, out)
    return out


def rows(n, seed, whole):
    """Classes that overlap; ``whole`` gives few distinct values with many ties, else thousands."""
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3))
    kind = np.where(x[:, 0] + x[:, 1] + rng.normal(0, 0.5, n) > 1.2, "DDoS", np.where(x[:, 2] * x[:, 0] > 0.8, "PortScan", "Benign"))
    kind[:5] = "Rare"
    return kind, np.round(x * 2) if whole else x


@pytest.mark.parametrize(("whole", "min_leaf", "depth"), [(True, 10, 3), (False, 10, 3), (False, 1, 4), (False, 40, 2)])
def test_same_trees_as_an_exhaustive_search(spark, monkeypatch, whole, min_leaf, depth):
    kind, x = rows(3000, 1, whole)
    flows = spark.createDataFrame([(str(k), *map(float, v)) for k, v in zip(kind, x, strict=True)], SCHEMA).repartition(5)
    found = decision_trees(flows, ["a", "b", "c"], max_depth=depth, min_leaf=min_leaf)
    assert sorted(found.trees) == ["DDoS", "PortScan"]
    for attack, tree in found.trees.items():
        expected = plain_tree(x, kind == attack, depth, min_leaf)
        assert {i: (t.n, t.positives, t.feature, t.threshold) for i, t in tree.nodes.items()} == expected
        guess = flows.select((F.col("attack_type") == attack).alias("y"), tree.predict().alias("g"))
        tp, named, hits, right = guess.agg(
            F.count_if(F.expr("y AND g")), F.count_if("g"), F.count_if("y"), F.count_if(F.col("y") == F.col("g"))
        ).first()
        assert tree.quality() == pytest.approx((right / 3000, tp / named, tp / hits))
        assert sum(tree.importances().values()) == pytest.approx(1.0)
    shares = found.importances.groupBy("attack_type").agg(F.sum("importance").alias("s"), F.count("*").alias("n")).collect()
    assert all(r.s == pytest.approx(1.0) and r.n == 3 for r in shares)


def test_one_round_of_passes_a_level_for_any_number_of_classes(spark, monkeypatch):
    levels = []
    plain = trees_module._best_cuts
    monkeypatch.setattr(trees_module, "_best_cuts", lambda *a: levels.append(1) or plain(*a))
    data = [(f"kind{i % 6}" if i % 3 else "Benign", float(i % 6), float(i % 7), float(i)) for i in range(1200)]
    found = decision_trees(spark.createDataFrame(data, SCHEMA), ["a", "b", "c"])
    assert len(found.trees) == 4 and len(levels) <= 3


def test_nothing_to_split(spark):
    same = [("DDoS" if i % 2 else "Benign", 1.0, None, 2.0) for i in range(100)]
    found = decision_trees(spark.createDataFrame(same, SCHEMA), ["a", "b", "c"])
    assert found.rules.count() == 0 and found.importances.filter("importance > 0").count() == 0
    assert [tuple(r) for r in found.metrics.collect()] == [("DDoS", 0.5, 0.0, 0.0)]
    few = spark.createDataFrame([("DDoS", 1.0, 1.0, 1.0)] * 5 + [("Benign", 0.0, 0.0, 0.0)] * 50, SCHEMA)
    assert decision_trees(few, ["a"]).trees == {} and decision_trees(few, ["a"]).metrics.count() == 0


def test_slices_of_the_sort_do_not_matter(spark, monkeypatch):
    kind, x = rows(2000, 3, False)
    flows = spark.createDataFrame([(str(k), *map(float, v)) for k, v in zip(kind, x, strict=True)], SCHEMA)
    whole = decision_trees(flows, ["a", "b"]).trees
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert decision_trees(flows.repartition(9), ["a", "b"]).trees == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert ordering.SLICES > 0

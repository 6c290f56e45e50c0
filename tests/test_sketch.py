import random

import pytest

from edgewatch.config import ScorerConfig
from edgewatch.operators import sketch


def cells(df):
    return {(r.row, r.col): r.cnt for r in df.collect()}


@pytest.mark.parametrize("items,repeats,width,depth", [(100, 100, 200, 5), (400, 5, 50, 3), (30, 50, 8, 2)])
def test_estimates_stay_within_the_bound(spark, items, repeats, width, depth):
    cfg = ScorerConfig(width=width, depth=depth)
    df = spark.range(items * repeats).selectExpr(f"concat('item', id % {items}) AS key")
    built = sketch.build_sketch(df, "key", cfg)
    found = {r.key: r.estimate for r in sketch.estimate_counts(built, df, "key", cfg).collect()}
    assert len(found) == items
    assert all(v >= repeats for v in found.values())
    bound = sketch.max_overestimate(cfg, items * repeats)
    beyond = sum(v - repeats > bound for v in found.values())
    assert beyond <= max(1, 3 * items * sketch.error_bounds(cfg)[1])


def test_size_is_fixed(spark):
    cfg = ScorerConfig(width=16, depth=3)
    df = spark.range(5000).selectExpr("cast(id AS string) AS key")
    assert sketch.build_sketch(df, "key", cfg).count() <= 48


def test_merge_equals_building_at_once(spark):
    cfg = ScorerConfig(width=32, depth=3)
    rng = random.Random(0)
    rows = [(f"k{rng.randint(0, 50)}",) for _ in range(500)]
    left, right = (spark.createDataFrame(r, "key string") for r in (rows[:200], rows[200:]))
    merged = sketch.merge_sketches(
        sketch.build_sketch(left, "key", cfg), sketch.build_sketch(right, "key", cfg)
    )
    assert cells(merged) == cells(sketch.build_sketch(left.union(right), "key", cfg))


def test_weighted_counts_and_unknown_key(spark):
    cfg = ScorerConfig(width=1000, depth=4)
    built = sketch.build_sketch(spark.createDataFrame([("a", 5), ("a", 2), ("b", 1)], "key string, n long"), "key", cfg, "n")
    asked = spark.createDataFrame([("a",), ("b",), ("never",)], "key string")
    found = {r.key: r.estimate for r in sketch.estimate_counts(built, asked, "key", cfg).collect()}
    assert found == {"a": 7, "b": 1, "never": 0}


def test_decay_rounds_down(spark):
    built = spark.createDataFrame([(0, 0, 1), (0, 1, 50), (0, 2, 100)], "row int, col int, cnt long")
    assert cells(sketch.decay_sketch(built, 0.98)) == {(0, 0): 0, (0, 1): 49, (0, 2): 98}
    for factor in (0, 1, 1.5):
        with pytest.raises(ValueError):
            sketch.decay_sketch(built, factor)


def test_error_bounds():
    epsilon, delta = sketch.error_bounds(ScorerConfig())
    assert epsilon == pytest.approx(0.001359, abs=1e-6)
    assert delta == pytest.approx(0.006738, abs=1e-6)


def test_quality_of_all_estimates(spark):
    cfg = ScorerConfig(width=40, depth=4)
    rows = [(f"k{i % 97}",) for i in range(3000)] + [(None,)] * 5
    found = sketch.estimate_quality(spark.createDataFrame(rows, "k string"), "k", cfg).first()
    assert (found["keys"], found["items"], found["underestimated"]) == (97, 3000, 0)
    assert 0 <= found["largest_overestimate"] <= 3000
    assert found["beyond_bound"] <= 97 * 4 * sketch.error_bounds(cfg)[1]
    none = sketch.estimate_quality(spark.createDataFrame([], "k string"), "k", cfg).first()
    assert (none["keys"], none["items"], none["beyond_bound"]) == (0, 0, 0)

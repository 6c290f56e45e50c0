"""Curves and areas against counts over all pairs."""

import random

import pytest

from edgewatch.operators import curves

SCHEMA = "score double, label int"


def rows(n, seed, values):
    rnd = random.Random(seed)
    return [(float(rnd.randrange(values)) / 7, int(rnd.random() < 0.3)) for _ in range(n)]


@pytest.mark.parametrize("values", [3, 50, 10_000])
def test_against_all_pairs(spark, values):
    data = rows(400, values, values)
    df = spark.createDataFrame([*data, (None, 1), (1.0, None), (float("nan"), 0)], SCHEMA).repartition(5)
    hits = [s for s, y in data if y]
    others = [s for s, y in data if not y]
    row = curves.separation(df).first()
    assert (row.positives, row.negatives) == (len(hits), len(others))
    pairs = sum((a > b) + 0.5 * (a == b) for a in hits for b in others)
    assert row.auc == pytest.approx(pairs / len(hits) / len(others))
    curve = {r.threshold: r for r in curves.threshold_curve(df).collect()}
    assert set(curve) == {s for s, _ in data}
    average = 0.0
    for t, r in curve.items():
        flagged = sum(s >= t for s, _ in data)
        found = sum(s >= t for s in hits)
        assert (r.flagged, r.true_positives) == (flagged, found)
        assert (r.precision, r.recall) == pytest.approx((found / flagged, found / len(hits)))
        average += sum(s == t for s in hits) * found / flagged / len(hits)
    assert row.average_precision == pytest.approx(average)


def test_one_class_only(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], SCHEMA)
    assert tuple(curves.separation(df).first()) == (0, 2, None, None)
    assert [r.recall for r in curves.threshold_curve(df).collect()] == [0.0, 0.0]
    none = spark.createDataFrame([], SCHEMA)
    assert tuple(curves.separation(none).first()) == (0, 0, None, None)
    assert curves.threshold_curve(none).count() == 0

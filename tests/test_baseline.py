import random
import statistics
from collections import Counter

import pytest

from edgewatch.operators import baseline, edges
from edgewatch.plans.detection import evaluate_batch
from traffic import burst_traffic

SCHEMA = "src string, dst string, timestamp bigint, label smallint"


def traffic(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        hot = rng.random() < 0.35
        src, dst = ("a", "z") if hot else (f"h{rng.randint(0, 9)}", f"h{rng.randint(0, 9)}")
        rows.append((src, dst, 5000 + rng.randint(0, 300), int(rng.random() < 0.1)))
    return rows


def naive_flags(rows, window, threshold):
    start = min(r[2] for r in rows)
    buckets = {}
    for src, dst, ts, _ in rows:
        buckets.setdefault((ts - start) // window, Counter())[(src, dst)] += 1
    flags, history = {}, Counter()
    for bucket in sorted(buckets):
        counts = list(history.values())
        mean = sum(counts) / len(counts) if counts else 0
        spread = statistics.stdev(counts) if len(counts) > 1 else 0
        spread = spread if spread > 0 else 1.0
        for edge, n in buckets[bucket].items():
            z = (n - mean) / spread
            if z >= threshold:
                flags[(*edge, bucket)] = (n, z, start + (bucket + 1) * window)
        history.update(buckets[bucket])
    return flags


@pytest.mark.parametrize("window,threshold", [(10, 2.5), (25, 1.0), (1000, 2.5)])
def test_flags_equal_rescanning(spark, window, threshold):
    rows = traffic(1)
    found = baseline.zscore_flags(spark.createDataFrame(rows, SCHEMA), window, threshold).collect()
    expected = naive_flags(rows, window, threshold)
    assert {(r.src, r.dst, r.bucket) for r in found} == set(expected)
    for r in found:
        n, z, at = expected[(r.src, r.dst, r.bucket)]
        assert (r.count_in_window, r.flagged_at_time) == (n, at)
        assert r.z_score == pytest.approx(z)


def test_prefix_sums_over_many_blocks(spark, monkeypatch):
    from edgewatch.functions import ordering

    monkeypatch.setattr(ordering, "POSITION_BLOCK", 3)
    rows = traffic(2)
    found = baseline.zscore_flags(spark.createDataFrame(rows, SCHEMA), 10, 2.5).collect()
    assert {(r.src, r.dst, r.bucket) for r in found} == set(naive_flags(rows, 10, 2.5))


def test_equal_history_has_unit_deviation(spark):
    rows = [("a", "b", 0, 0), ("c", "d", 1, 0), ("a", "b", 10, 0)]
    counts = baseline.edge_bucket_counts(spark.createDataFrame(rows, SCHEMA), 10)
    got = {r.bucket: r for r in baseline.history_moments(counts).collect()}
    assert (got[0].mean_count, got[0].std_count) == (0.0, 1.0)
    assert (got[1].mean_count, got[1].std_count, got[1].history_edges) == (1.0, 1.0, 2)


def test_precision_and_recall(spark):
    truth = spark.createDataFrame([("a", "b"), ("c", "d")], "src string, dst string")
    flagged = spark.createDataFrame([("a", "b"), ("a", "b"), ("x", "y"), ("p", "q")], "src string, dst string")
    none = flagged.filter("src = 'none'")
    got = {r.method: r for r in edges.precision_recall(truth, one=flagged, empty=none).collect()}
    assert (got["one"].flagged_edges, got["one"].true_positives) == (3, 1)
    assert (got["one"].precision, got["one"].recall) == (pytest.approx(1 / 3), 0.5)
    assert (got["empty"].precision, got["empty"].recall, got["empty"].true_edges) == (0.0, 0.0, 2)
    both = edges.precision_recall(none, one=none).first()
    assert (both.precision, both.recall, both.true_edges) == (0.0, 0.0, 0)


def test_truth_and_sets(spark):
    df = spark.createDataFrame([("a", "b", 1, 1), ("a", "b", 2, 0), ("c", "d", 3, 0)], SCHEMA)
    assert [tuple(r) for r in edges.truth_edges(df).collect()] == [("a", "b")]
    assert edges.common_edges(df, edges.truth_edges(df)).count() == 1


def test_generated_burst_is_flagged(spark):
    result = evaluate_batch(burst_traffic(spark), window=10, threshold=2.5).first()
    assert result.recall == 1.0


def test_totals(spark):
    df = spark.createDataFrame(traffic(3), SCHEMA)
    counts, flags = baseline.edge_bucket_counts(df, 10), baseline.zscore_flags(df, 10, 2.5)
    row = baseline.flag_totals(counts, flags).first()
    expected = naive_flags(traffic(3), 10, 2.5)
    assert row.windows == len({(r[2] - min(x[2] for x in traffic(3))) // 10 for r in traffic(3)})
    assert (row.flagged_events, row.flagged_edges) == (len(expected), len({k[:2] for k in expected}))

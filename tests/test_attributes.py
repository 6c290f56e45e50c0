import numpy as np
import pytest
from pyspark.sql import functions as F

from edgewatch.functions import ordering
from edgewatch.operators import attributes
from edgewatch.operators.trees import decision_trees

FEATURES = ["Flow Duration", "Flow Packets/s", "SYN Flag Count", "Constant"]


def table(n=600, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = ["Benign", "Benign", "Benign", "DDoS", "PortScan"][i % 5] if i > 4 else "Rare"
        rate = float(rng.exponential(500 if kind == "DDoS" else 50))
        syn = float(rng.poisson(40 if kind == "PortScan" else 2))
        duration = float(rng.exponential(5000)) if i % 7 else None
        rows.append((kind, duration, rate, syn, 3.0))
    return rows


@pytest.fixture(scope="module")
def flows(spark):
    schema = "attack_type string, `Flow Duration` double, `Flow Packets/s` double, `SYN Flag Count` double, Constant double"
    return spark.createDataFrame(table(), schema).cache()


def values(kind, at):
    return np.array([r[at] for r in table() if r[0] == kind and r[at] is not None])


def test_cliffs_delta_equals_all_pairs(flows):
    found = attributes.cliffs_delta(flows, FEATURES).collect()
    assert len(found) == 12
    for r in found:
        at = FEATURES.index(r.feature) + 1
        x, y = values("Benign", at), values(r.attack_type, at)
        pairs = np.sign(x[:, None] - y[None, :])
        assert r.cliff_delta == pytest.approx(pairs.sum() / (len(x) * len(y)))


@pytest.mark.parametrize("partitions", ["4", "23"])
def test_statistics(spark, flows, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = attributes.feature_statistics(flows, FEATURES).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found) == 12
    for r in found:
        at = FEATURES.index(r.feature) + 1
        x, y = values("Benign", at), values(r.attack_type, at)
        assert r.benign_median == pytest.approx(np.median(x))
        assert r.attack_median == pytest.approx(np.median(y))
        assert r.benign_iqr == pytest.approx(np.quantile(x, 0.75) - np.quantile(x, 0.25))
        assert r.attack_iqr == pytest.approx(np.quantile(y, 0.75) - np.quantile(y, 0.25))
        widest = max(np.ptp(x), np.ptp(y))
        apart = abs(np.median(x) - np.median(y))
        assert r.discrimination == pytest.approx(apart / widest if widest else 0.0)


def test_statistics_without_classes_or_values(spark):
    schema = "attack_type string, x double, y double"
    assert attributes.feature_statistics(spark.createDataFrame([], schema), ["x"]).count() == 0
    assert attributes.cliffs_delta(spark.createDataFrame([("A", 1.0, None)], schema), ["x"]).count() == 0
    rows = [("A", 1.0, None), ("A", 4.0, None), ("Benign", 2.0, 3.0), (None, 9.0, 9.0)]
    found = attributes.feature_statistics(spark.createDataFrame(rows, schema), ["x", "y"]).collect()
    assert [tuple(r)[:4] for r in found] == [("A", "x", 2.0, 0.0)]
    assert (found[0].attack_median, found[0].attack_iqr, found[0].cliff_delta) == (2.5, 1.5, 0.0)


def test_importance(flows):
    found = attributes.feature_importance(flows, FEATURES, 600).collect()
    assert {r.attack_type for r in found} == {"DDoS", "PortScan"}  # the rare class has too few rows
    kinds = np.array([r[0] for r in table()])
    for r in found:
        raw = [row[FEATURES.index(r.feature) + 1] for row in table()]
        middle = np.median([x for x in raw if x is not None])
        x = np.array([middle if v is None else v for v in raw])
        edges = np.unique(np.quantile(x, np.linspace(0, 1, 6)))
        bins = np.maximum(0, np.searchsorted(edges, x, side="left") - 1)
        y = kinds == r.attack_type

        def entropy(labels):
            p = np.unique(labels, return_counts=True)[1] / len(labels)
            return -np.sum(p * np.log2(p + 1e-10))

        information = entropy(bins) + entropy(y) - entropy(bins * 2 + y)
        assert r.importance == pytest.approx(max(0.0, information), abs=1e-9)
    best = {r.attack_type: r.feature for r in found if r["rank"] == 1}
    assert best == {"DDoS": "Flow Packets/s", "PortScan": "SYN Flag Count"}
    assert {r.importance for r in found if r.feature == "Constant"} == {0.0}


def test_correlation(flows):
    found = {(r.feature_1, r.feature_2): r.correlation for r in attributes.correlation_matrix(flows, FEATURES).collect()}
    assert len(found) == 16
    columns = []
    for at in (1, 2, 3):
        raw = [r[at] for r in table()]
        middle = np.median([x for x in raw if x is not None])
        columns.append([middle if v is None else v for v in raw])
    expected = np.corrcoef(columns)
    for i in range(3):
        for j in range(3):
            assert found[(FEATURES[i], FEATURES[j])] == pytest.approx(expected[i][j])
    assert found[("Constant", "Constant")] is None and found[("Constant", FEATURES[0])] is None


def test_trees_and_table(flows):
    trees = decision_trees(flows, FEATURES)
    quality = {r.attack_type: r for r in trees.metrics.collect()}
    assert set(quality) == {"DDoS", "PortScan"}
    assert quality["PortScan"].recall > 0.9 and quality["PortScan"].precision > 0.9
    rules = trees.rules.orderBy("attack_type", "position").collect()
    first = [r for r in rules if r.attack_type == "PortScan"][:2]
    assert [(r.feature, r.direction) for r in first] == [("SYN Flag Count", "<="), ("SYN Flag Count", ">")]
    assert len(trees.trees["PortScan"].splits(max_depth=0)) == 1
    assert all(len([r for r in rules if r.attack_type == a]) <= 14 for a in quality)

    stats = attributes.feature_statistics(flows, FEATURES)
    rows = {r.attack_type: r for r in attributes.attribute_table(flows, stats, trees.metrics, FEATURES).collect()}
    assert set(rows) == {"DDoS", "PortScan"}
    row = rows["PortScan"]
    assert row.key_features.split(", ")[0] == "SYN Flag Count" and len(row.key_features.split(", ")) == 3
    assert row.suggested_rule == "SYN Flag Count > 3.00"
    assert row.benign_range.startswith("2±") and row.support_percent == pytest.approx(119 / 6)
    assert row.rule_recall == quality["PortScan"].recall
    assert "Rare" in {r.attack_type for r in attributes.attribute_table(flows, stats, None, FEATURES).collect()}


def test_suggested_rules(spark):
    df = spark.createDataFrame([("f", 10.0, 4.0), ("f", 1.0, 4.0), ("f", 5.0, 4.0), ("f", 2.0, 0.0)], "f string, a double, b double")
    rules = df.select(attributes.suggested_rule(df.f, df.a, df.b).alias("r")).collect()
    assert [r.r for r in rules] == ["f > 6.00", "f < 2.00", "f in anomaly distribution", "f > 1.00"]


def test_slices_decide_the_balance_only(flows, monkeypatch):
    def results():
        frames = (
            attributes.feature_statistics(flows, FEATURES),
            attributes.feature_importance(flows, FEATURES, 600),
            attributes.correlation_matrix(flows, FEATURES, 600),
        )
        return [
            sorted(tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in f.collect())
            for f in frames
        ]

    whole = results()
    monkeypatch.setattr(ordering, "ROWS_PER_SLICE", 5)
    assert results() == whole


def test_nan_is_a_gap_like_null(spark):
    rows = [("Benign" if i % 2 else "A", float(i % 7) if i % 5 else None, float(i)) for i in range(200)]
    nulls = spark.createDataFrame(rows, "attack_type string, x double, y double")
    nans = nulls.withColumn("x", F.coalesce("x", F.lit(float("nan"))))
    for analyse in (attributes.feature_importance, attributes.correlation_matrix):
        pair = [sorted(map(tuple, analyse(f, ["x", "y"]).collect())) for f in (nulls, nans)]
        assert pair[0] == pair[1]
    pair = [sorted(map(tuple, decision_trees(f, ["x", "y"]).metrics.collect())) for f in (nulls, nans)]
    assert pair[0] == pair[1] and pair[0]

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgewatch.functions import ordering
from edgewatch.functions.sizing import join_sized
from edgewatch.operators.replay import sample_per_file, sample_rows


@pytest.mark.parametrize("per_slice", [10_000, 50])
def test_quantiles_equal_interpolation(spark, per_slice):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(900):
        kind = "hot" if i % 3 else f"k{i % 4}"
        x = float(rng.exponential(10)) if i % 5 else None
        rows.append((kind, x, float(rng.integers(0, 4)), 7.0))
    df = spark.createDataFrame(rows, "kind string, `a b` double, c double, d double")
    probabilities = [0.0, 0.2, 0.25, 0.5, 0.9, 1.0]
    found = ordering.exact_quantiles(
        df, ["a b", "c", "d"], probabilities, "kind", rows=900, rows_per_slice=per_slice
    ).collect()
    assert len(found) == 3 * len({r[0] for r in rows})
    for r in found:
        at = {"a b": 1, "c": 2, "d": 3}[r.feature]
        values = [x[at] for x in rows if x[0] == r.kind and x[at] is not None]
        assert (r.n, r.low, r.high) == (len(values), min(values), max(values))
        for i, p in enumerate(probabilities):
            assert r[f"q{i}"] == pytest.approx(np.quantile(values, p))


def test_quantiles_of_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    for per_slice in (100, 1):
        found = ordering.exact_quantiles(df, ["a", "b"], [0.5], rows=2, rows_per_slice=per_slice)
        assert [(r.feature, r.q0) for r in found.collect()] == [("b", 1.5)]


def test_prefix_sums(spark, monkeypatch):
    monkeypatch.setattr(ordering, "POSITION_BLOCK", 4)
    df = spark.createDataFrame([(3 * i, i + 1) for i in range(30)], "p long, v long")
    got = {r.p: r.v_before for r in ordering.with_prefix_sums(df, "p", ["v"]).collect()}
    assert got == {3 * i: i * (i + 1) // 2 for i in range(30)}


@pytest.mark.parametrize("block", [4, 4096])
def test_dense_ranks(spark, monkeypatch, block):
    monkeypatch.setattr(ordering, "POSITION_BLOCK", block)
    df = spark.createDataFrame([(p,) for p in [5, 9, 9, 70_000, 2, 5]], "p long")
    got = {r.p: r._rank for r in ordering.dense_ranks(df, "p").collect()}
    assert got == {2: 1, 5: 2, 9: 3, 70_000: 4}


def test_row_index_over_several_splits(spark, tmp_path):
    for name, low, high in (("b", 300, 350), ("a", 0, 300)):
        with open(tmp_path / f"{name}.csv", "w") as f:
            f.writelines(f"row{i},{'x' * 40}\n" for i in range(low, high))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        scan = spark.read.schema("name string, pad string").csv(str(tmp_path))
        assert scan.rdd.getNumPartitions() > 4
        rows = ordering.with_row_index(scan).select("row_idx", "name").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.row_idx, r.name) for r in rows) == [(i, f"row{i}") for i in range(350)]


def test_row_index_of_parquet(spark, tmp_path):
    for name, low, high in (("a", 0, 70), ("b", 70, 100)):
        spark.range(low, high).coalesce(1).write.parquet(f"{tmp_path}/t/{name}")
    scan = spark.read.parquet(f"{tmp_path}/t/a", f"{tmp_path}/t/b")
    rows = ordering.with_row_index(scan, parquet=True).collect()
    assert sorted((r.row_idx, r.id) for r in rows) == [(i, i) for i in range(100)]


def test_sample_per_group_is_exact_and_stable(spark):
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, concat('g', id % 10), 'hot') AS g")
    first = sample_per_file(df, "g", 40, ["id"]).collect()
    again = sample_per_file(df.repartition(7), "g", 40, ["id"]).collect()
    assert {tuple(r) for r in first} == {tuple(r) for r in again}
    sizes = {}
    for r in first:
        sizes[r.g] = sizes.get(r.g, 0) + 1
    assert set(sizes.values()) == {40}
    small = df.filter("id < 10")
    assert sample_per_file(small, "g", 40, ["id"]).count() == 10


def test_sample_rows(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    picked = sample_rows(df, 100, ["id"])
    assert picked.columns == ["id", "x"] and picked.count() == 100
    assert sample_rows(df, 5000, ["id"]).count() == 1000


def test_running_sums_over_range_partitions(spark):
    rows = [(k, float(v), v % 4) for k in ("hot", "b", None) for v in range(500 if k == "hot" else 7)]
    df = spark.createDataFrame(rows, "k string, value double, n long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordering.with_running_sums(df.filter("k IS NOT NULL"), ["k"], ["n"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 507
    assert all(r.n_upto == sum(v % 4 for v in range(int(r.value) + 1)) for r in got)


def test_join_sized_broadcasts_within_its_bound_only(spark):
    left, right = spark.range(50).selectExpr("id % 5 AS k"), spark.range(5).selectExpr("id AS k")
    for bound, hinted in ((5, True), (600_000, False)):
        joined = join_sized(left, right, ["k"], bound)
        assert ("strategy=broadcast" in joined._jdf.queryExecution().analyzed().toString()) == hinted
        assert joined.count() == 50

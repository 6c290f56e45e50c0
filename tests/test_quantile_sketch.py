"""Sketches of files merge to those of all files, within their error."""

import numpy as np
from pyspark.sql import functions as F

from edgewatch.functions.quantile_sketch import feature_sketches, merged_sketches, rank_error, sketch_quantiles


def test_merged_files_give_the_quantiles_of_all(spark, tmp_path):
    rng = np.random.default_rng(1)
    files = [rng.exponential(1 + i, 20_000) for i in range(4)]
    for i, values in enumerate(files):
        rows = [("a" if k % 3 else "b", float(v), None if k % 5 else float(k)) for k, v in enumerate(values)]
        flows = spark.createDataFrame(rows, "kind string, x double, y double").repartition(3)
        feature_sketches(flows, ["x", "y"], "kind").write.parquet(f"{tmp_path}/file={i}")
    merged = merged_sketches(spark.read.parquet(str(tmp_path)), "kind")
    for r in sketch_quantiles(merged, "kind", [0.25, 0.5, 0.9]).collect():
        if r.feature == "x":
            own = np.sort(np.concatenate([v[[k for k in range(20_000) if (k % 3 > 0) == (r.kind == "a")]] for v in files]))
            assert r.n == len(own)
            for q, p in ((r.q0, 0.25), (r.q1, 0.5), (r.q2, 0.9)):
                assert abs(np.searchsorted(own, q) / len(own) - p) < 1.5 * rank_error()
        else:
            assert r.n == 4 * sum((k % 3 > 0) == (r.kind == "a") for k in range(0, 20_000, 5))


def test_groups_without_values_have_no_sketch(spark):
    flows = spark.createDataFrame([("a", None, 1.0)], "kind string, x double, y double")
    rows = sketch_quantiles(feature_sketches(flows, ["x", "y"], "kind"), "kind", [0.5]).collect()
    assert [(r.feature, r.n, r.q0) for r in rows] == [("y", 1, 1.0)]
    assert merged_sketches(feature_sketches(flows.limit(0), ["x"], "kind"), "kind").agg(F.count("*")).first()[0] == 0

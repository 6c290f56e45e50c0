"""Quantiles from sketches that are made once per file and merged, so earlier files are not read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewatch.functions.ordering import Slices, long_form

#: Size of a sketch; a normalised rank is off by no more than ``rank_error`` in 99 of 100 cases.
SKETCH_SIZE = 400


def rank_error(size: int = SKETCH_SIZE) -> float:
    """Two-sided error of one rank, the usual fit for this family of sketches."""
    return 2.296 / size**0.9021


def feature_sketches(flows: DataFrame, features: list[str], by: str, size: int = SKETCH_SIZE) -> DataFrame:
    """``by, feature, sketch``: one sketch of the values per group and feature, gaps left out."""
    cells = long_form(flows, features, Slices({}), F.col(by))
    return cells.groupBy(by, "feature").agg(F.kll_sketch_agg_double("value", size).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: str, size: int = SKETCH_SIZE) -> DataFrame:
    """One sketch per group and feature from those of any number of files."""
    return sketches.groupBy(by, "feature").agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, by: str, probabilities: list[float]) -> DataFrame:
    """``by, feature, n, q0, q1, ...`` at the probabilities; a value of the data, not one between two."""
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(probabilities)]
    return sketches.select(by, "feature", F.kll_sketch_get_n_double("sketch").alias("n"), *found)

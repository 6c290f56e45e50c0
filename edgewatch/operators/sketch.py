"""Count-Min sketches as tables of cells ``(row, col, cnt)``.

A sketch is additive: building is a grouped sum, merging is a union and a sum. Its size is fixed at
``depth * width`` cells whatever it counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewatch.config import ScorerConfig


def hash_column(key: Column, seed: int, width: int, hash_fn: str = "xxhash64") -> Column:
    """Column index of ``key`` in a row hashed with ``seed``."""
    if hash_fn == "md5":
        digest = F.md5(F.concat(F.lit(f"{seed}:"), key))
        number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    else:
        number = F.xxhash64(F.lit(seed), key)
    return F.pmod(number, F.lit(width)).cast("bigint")


def cell_ids(key: Column, cfg: ScorerConfig, first_row: int = 0) -> list[Column]:
    """One cell number ``row * width + col`` per sketch row, rows starting at ``first_row``."""
    return [
        F.lit(row * cfg.width).cast("bigint")
        + hash_column(key, cfg.seed + row, cfg.width, cfg.hash_fn)
        for row in range(first_row, first_row + cfg.depth)
    ]


def build_sketch(items: DataFrame, key: str, cfg: ScorerConfig, count: str | None = None) -> DataFrame:
    """Sketch of ``items``. Equal keys are summed before they are hashed and spread over the rows."""
    added = F.sum(count) if count else F.count(F.lit(1))
    per_key = items.groupBy(key).agg(added.alias("cnt"))
    cells = per_key.select("cnt", F.explode(F.array(*cell_ids(F.col(key), cfg))).alias("_cell"))
    totals = cells.groupBy("_cell").agg(F.greatest(F.sum("cnt"), F.lit(0)).alias("cnt"))
    return totals.select(
        F.floor(F.col("_cell") / F.lit(cfg.width)).cast("int").alias("row"),
        (F.col("_cell") % cfg.width).cast("int").alias("col"),
        F.col("cnt").cast("bigint").alias("cnt"),
    )


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """Sum of sketches that share width, depth, seed and hash."""
    merged = sketches[0]
    for other in sketches[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy("row", "col").agg(F.sum("cnt").alias("cnt"))


def decay_sketch(sketch: DataFrame, factor: float) -> DataFrame:
    """Every counter times ``factor``, rounded down."""
    if not 0 < factor < 1:
        raise ValueError("factor must lie in (0, 1)")
    return sketch.withColumn("cnt", F.floor(F.col("cnt") * F.lit(factor)).cast("bigint"))


def estimate_counts(sketch: DataFrame, keys: DataFrame, key: str, cfg: ScorerConfig) -> DataFrame:
    """``(key, estimate)`` for the distinct keys: the smallest of a key's cells, 0 if one is empty."""
    distinct = keys.select(key).distinct()
    probes = distinct.select(key, F.explode(F.array(*cell_ids(F.col(key), cfg))).alias("_cell"))
    cells = sketch.select(
        (F.col("row").cast("bigint") * cfg.width + F.col("col")).alias("_cell"), "cnt"
    )
    if cfg.width * cfg.depth <= 1_000_000:
        cells = F.broadcast(cells)
    found = probes.join(cells, "_cell", "left")
    smallest = F.min(F.coalesce(F.col("cnt"), F.lit(0)))
    return found.groupBy(key).agg(smallest.cast("bigint").alias("estimate"))


def error_bounds(cfg: ScorerConfig) -> tuple[float, float]:
    """(epsilon, delta): an estimate exceeds the count by more than epsilon * N with chance delta."""
    return math.e / cfg.width, math.exp(-cfg.depth)


def max_overestimate(cfg: ScorerConfig, items: int) -> float:
    return error_bounds(cfg)[0] * items


def estimate_quality(items: DataFrame, key: str, cfg: ScorerConfig) -> DataFrame:
    """One row about all keys: ``keys, items, underestimated, largest_overestimate, beyond_bound``.

    Every estimate is compared with its key's true count; null keys are left out. ``beyond_bound`` counts
    the keys that exceed it by more than epsilon times the items.
    """
    items = items.filter(F.col(key).isNotNull())
    counts = items.groupBy(key).agg(F.count(F.lit(1)).alias("true"))
    whole = items.count()
    estimates = estimate_counts(build_sketch(items, key, cfg), items, key, cfg)
    compared = counts.join(estimates, key)
    over = F.col("estimate") - F.col("true")
    return compared.agg(
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum("true"), F.lit(0)).alias("items"),
        F.count_if(over < 0).alias("underestimated"),
        F.max(over).alias("largest_overestimate"),
        F.count_if(over > max_overestimate(cfg, whole)).alias("beyond_bound"),
    )

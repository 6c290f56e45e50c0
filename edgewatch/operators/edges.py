"""Edge events, edge sets and edge-level evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING_ADDRESS = "0.0.0.0"


def as_edges(
    df: DataFrame, src: Column, dst: Column, timestamp: Column, event_id: Column, **extra: Column
) -> DataFrame:
    """Project any table to edge events; ids become strings and missing ones ``0.0.0.0``."""
    return df.select(
        F.coalesce(src.cast("string"), F.lit(MISSING_ADDRESS)).alias("src"),
        F.coalesce(dst.cast("string"), F.lit(MISSING_ADDRESS)).alias("dst"),
        timestamp.cast("bigint").alias("timestamp"),
        event_id.cast("bigint").alias("event_id"),
        *[column.alias(name) for name, column in extra.items()],
    )


def distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").distinct()


def truth_edges(events: DataFrame) -> DataFrame:
    """Edges with at least one event labelled 1."""
    return distinct_edges(events.filter(F.col("label") == 1))


def common_edges(left: DataFrame, right: DataFrame) -> DataFrame:
    return distinct_edges(left).intersect(distinct_edges(right))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def edge_hits(truth: DataFrame, **methods: DataFrame) -> DataFrame:
    """One row per edge that is true or flagged: ``src, dst, is_true, <method>...`` (0 or 1).

    All sets are stacked and grouped once instead of being joined pairwise.
    """
    names = ["is_true", *methods]
    stacked = None
    for name, edges in zip(names, [truth, *methods.values()]):
        flags = [F.lit(1 if n == name else 0).alias(n) for n in names]
        part = edges.select("src", "dst", *flags)
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy("src", "dst").agg(*[F.max(n).alias(n) for n in names])


def precision_recall(truth: DataFrame, **methods: DataFrame) -> DataFrame:
    """``method, flagged_edges, true_edges, true_positives, precision, recall`` per method."""
    hits = edge_hits(truth, **methods)
    rows = [
        F.struct(
            F.lit(m).alias("method"),
            F.sum(m).alias("flagged_edges"),
            F.sum("is_true").alias("true_edges"),
            F.sum(F.col(m) * F.col("is_true")).alias("true_positives"),
        ).alias(m)
        for m in methods
    ]
    counts = hits.agg(*rows).select(F.inline(F.array(*[F.col(m) for m in methods])))
    return with_quality(counts)


def with_quality(counts: DataFrame) -> DataFrame:
    """Precision and recall beside the counts of edges, which are 0 where there are none."""
    whole = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("flagged_edges", "true_edges", "true_positives")}
    return counts.withColumns(whole).select(
        "*",
        _ratio(F.col("true_positives"), F.col("flagged_edges")).alias("precision"),
        _ratio(F.col("true_positives"), F.col("true_edges")).alias("recall"),
    )

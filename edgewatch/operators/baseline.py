"""Batch baseline: z-score of an edge's count in a time window against all earlier windows.

The history of a window is the total count of every edge seen before it. Rescanning it per window
would cost windows x rows. With ``p`` the count an edge had before a window and ``k`` its count in
it, the window adds ``k`` events, ``[p = 0]`` edges and ``(p + k)^2 - p^2`` to the sum of squares, so
the moments of every history are prefix sums over windows of those three numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgewatch.functions.ordering import with_prefix_sums
from edgewatch.functions.scalar import bucket_of
from edgewatch.functions.sizing import join_sized


@dataclass(frozen=True)
class Span:
    """First and last timestamp of a stream."""

    low: int
    high: int

    def buckets(self, window: int) -> int:
        return (self.high - self.low) // window + 1


def time_span(events: DataFrame) -> Span:
    row = events.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")).first()
    return Span(int(row.low or 0), int(row.high or 0))


def edge_bucket_counts(events: DataFrame, window: int, span: Span | None = None) -> DataFrame:
    """``bucket, src, dst, count_in_window``; buckets are counted from the first timestamp."""
    span = span or time_span(events)
    bucket = bucket_of(F.col("timestamp"), span.low, window).alias("bucket")
    return (
        events.select(bucket, "src", "dst")
        .groupBy("bucket", "src", "dst")
        .agg(F.count(F.lit(1)).alias("count_in_window"))
    )


def history_moments(counts: DataFrame) -> DataFrame:
    """``bucket, history_events, history_edges, mean_count, std_count`` before every bucket.

    The standard deviation is the sample one, and 1 where it is zero or undefined. That is decided
    on whole numbers, so it does not depend on rounding.
    """
    earlier = (
        Window.partitionBy("src", "dst")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    wide = "decimal(38,0)"
    k = F.col("count_in_window").cast(wide)
    p = F.coalesce(F.sum("count_in_window").over(earlier), F.lit(0))
    steps = counts.select("bucket", k.alias("k"), p.cast("decimal(18,0)").alias("p"))
    k, p = F.col("k").cast("decimal(18,0)"), F.col("p")
    per_bucket = steps.groupBy("bucket").agg(
        F.sum(F.col("k").cast("bigint")).alias("n"),
        F.sum(F.when(F.col("p") == 0, 1).otherwise(0)).alias("e"),
        F.sum((k * (p + p + k)).cast(wide)).cast(wide).alias("q"),
    )
    sums = with_prefix_sums(per_bucket, "bucket", ["n", "e", "q"])
    n, e, q = (F.col(f"{c}_before") for c in ("n", "e", "q"))
    # n * n and q * e as decimals: equal exactly when all earlier edges have the same count
    flat = (q.cast(wide) * e.cast("decimal(18,0)")).cast(wide) == (
        n.cast("decimal(18,0)") * n.cast("decimal(18,0)")
    ).cast(wide)
    spread = F.sqrt((q.cast("double") - n.cast("double") * n / e) / (e - 1))
    return sums.select(
        "bucket",
        n.cast("bigint").alias("history_events"),
        e.cast("bigint").alias("history_edges"),
        F.when(e > 0, n.cast("double") / e).otherwise(F.lit(0.0)).alias("mean_count"),
        F.when((e <= 1) | flat, F.lit(1.0)).otherwise(spread).alias("std_count"),
    )


def zscore_flags(
    events: DataFrame, window: int = 10, threshold: float = 2.5, span: Span | None = None
) -> DataFrame:
    """``src, dst, bucket, count_in_window, z_score, flagged_at_time`` of every z >= threshold."""
    span = span or time_span(events)
    counts = edge_bucket_counts(events, window, span)
    moments = history_moments(counts).select("bucket", "mean_count", "std_count")
    scored = join_sized(counts, moments, ["bucket"], span.buckets(window))
    z = (F.col("count_in_window") - F.col("mean_count")) / F.col("std_count")
    return (
        scored.withColumn("z_score", z)
        .filter(F.col("z_score") >= F.lit(float(threshold)))
        .select(
            "src",
            "dst",
            "bucket",
            "count_in_window",
            "z_score",
            (F.lit(span.low) + (F.col("bucket") + 1) * window).cast("bigint").alias("flagged_at_time"),
        )
    )


def flag_totals(counts: DataFrame, flags: DataFrame) -> DataFrame:
    """One row: windows processed, flagged events, flagged edges."""
    windows = counts.agg(F.count_distinct("bucket").alias("windows"))
    totals = flags.agg(
        F.count(F.lit(1)).alias("flagged_events"),
        F.count_distinct("src", "dst").alias("flagged_edges"),
    )
    # two one-row frames side by side
    return windows.select("windows", F.lit(1).alias("_k")).join(
        F.broadcast(totals.withColumn("_k", F.lit(1))), "_k"
    ).drop("_k")

"""Summaries of a scored stream and comparison of the two detectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewatch.operators.alerts import TEST_SOURCE, without_test_rows
from edgewatch.operators.edges import with_quality

METHODS = ("batch", "streaming")


def score_stats(scores: DataFrame, test_source: str = TEST_SOURCE) -> DataFrame:
    """One row over the ``scores`` table: counts, score range and seconds from event to ingestion."""
    delay = (F.unix_micros("ingested_at") - F.unix_micros("event_time")) / F.lit(1e6)
    late = F.when(F.col("is_alert"), delay)
    return without_test_rows(scores, test_source).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if("is_alert").alias("total_alerts"),
        F.min("anomaly_score").alias("min_score"),
        F.max("anomaly_score").alias("max_score"),
        F.avg("anomaly_score").alias("avg_score"),
        F.max(late).alias("max_detection_delay"),
        F.avg(late).alias("avg_detection_delay"),
    )


def method_comparison(truth: DataFrame, batch_flags: DataFrame, scores: DataFrame) -> DataFrame:
    """Batch and streaming detector on the same truth, one row each.

    ``flagged_events`` counts flags before they are collapsed to edges; the delays are those of the
    streaming detector's alerts and null for the batch one.
    """
    delay = (F.unix_micros("ingested_at") - F.unix_micros("event_time")) / F.lit(1e6)
    nothing = F.lit(None).cast("double")

    def flags(frame: DataFrame, name: str, delay: Column) -> DataFrame:
        marks = [F.lit(1 if n == name else 0).alias(n) for n in ("is_true", *METHODS)]
        return frame.select("src", "dst", *marks, delay.alias("delay"))

    # every input is read once: an edge's flags of both methods and its delays come from one grouping
    stacked = flags(truth, "is_true", nothing).unionByName(flags(batch_flags, "batch", nothing))
    stacked = stacked.unionByName(flags(scores.filter("is_alert"), "streaming", delay))
    per_edge = stacked.groupBy("src", "dst").agg(
        F.max("is_true").alias("is_true"),
        *[F.sum(m).alias(m) for m in METHODS],
        F.max("delay").alias("most"),
        F.sum("delay").alias("delays"),
    )
    rows = []
    for m in METHODS:
        streaming = m == "streaming"
        rows.append(
            F.struct(
                F.lit(m).alias("method"),
                F.count_if(F.col(m) > 0).alias("flagged_edges"),
                F.sum("is_true").alias("true_edges"),
                F.sum(F.when(F.col(m) > 0, F.col("is_true"))).alias("true_positives"),
                F.sum(m).alias("flagged_events"),
                (F.max("most") if streaming else nothing).alias("max_detection_delay"),
                (F.sum("delays") / F.sum(m) if streaming else nothing).alias("avg_detection_delay"),
            ).alias(m)
        )
    counts = per_edge.agg(*rows).select(F.inline(F.array(*METHODS)))
    return with_quality(counts).select(
        "method", "flagged_edges", "true_edges", "true_positives", "precision", "recall",
        F.coalesce("flagged_events", F.lit(0)).alias("flagged_events"),
        "max_detection_delay", "avg_detection_delay",
    )

"""How well scores separate labelled events, over all thresholds at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewatch.functions.ordering import with_running_sums


def _per_score(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Counts of positives and of all per distinct score, with those of all smaller ones; rows without either are left out."""
    known = scored.select(F.col(score).cast("double").alias("value"), (F.col(label) == 1).alias("hit"))
    known = known.filter(F.col("value").isNotNull() & F.col("hit").isNotNull() & ~F.isnan("value"))
    counts = known.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("p"))
    return with_running_sums(counts.withColumn("all", F.lit(0)), ["all"], ["n", "p"]).drop("all")


def _totals(sums: DataFrame) -> tuple[int, int]:
    """Rows and positives in all."""
    row = sums.agg(F.sum("n"), F.sum("p")).first()
    return row[0] or 0, row[1] or 0


def _flags(n: int, p: int) -> tuple[Column, Column]:
    """Events that reach a score, and the positives among them."""
    return n - F.col("n_upto") + F.col("n"), p - F.col("p_upto") + F.col("p")


def threshold_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``threshold, flagged, true_positives, precision, recall`` for each distinct score as threshold.

    An event is flagged if its score reaches the threshold, and positive if its label is 1. Recall is 0
    without positives.
    """
    sums = _per_score(scored, score, label)
    n, p = _totals(sums)
    flagged, hits = _flags(n, p)
    recall = hits / p if p else F.lit(0.0)
    return sums.select(
        F.col("value").alias("threshold"), flagged.alias("flagged"), hits.alias("true_positives"),
        (hits / flagged).alias("precision"), recall.alias("recall"),
    )


def separation(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row ``positives, negatives, auc, average_precision``.

    ``auc`` is the share of pairs of a positive and a negative event that the scores put in the right order,
    ties counting half, from rank sums over the distinct scores; ``average_precision`` weighs the precision
    at each threshold by the recall it adds. Both are null where a class is missing.
    """
    sums = _per_score(scored, score, label)
    n, p = _totals(sums)
    flagged, hits = _flags(n, p)
    equal = F.col("n") - F.col("p")
    below = F.col("n_upto") - F.col("p_upto") - equal  # negatives with a smaller score
    ordered = F.sum(F.col("p") * (below + equal / 2)) / float(p) / float(n - p) if 0 < p < n else F.first(F.lit(None).cast("double"))
    precise = F.sum(F.col("p") * hits / flagged) / float(p) if 0 < p < n else F.first(F.lit(None).cast("double"))
    return sums.agg(
        F.first(F.lit(p).cast("long")).alias("positives"), F.first(F.lit(n - p).cast("long")).alias("negatives"),
        ordered.alias("auc"), precise.alias("average_precision"),
    ).select(F.coalesce("positives", F.lit(0).cast("long")).alias("positives"),
             F.coalesce("negatives", F.lit(0).cast("long")).alias("negatives"), "auc", "average_precision")

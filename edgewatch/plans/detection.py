"""Both detectors over one stream, judged on the same truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from edgewatch.config import ScorerConfig
from edgewatch.operators.alerts import score_rows
from edgewatch.operators.baseline import zscore_flags
from edgewatch.operators.edges import precision_recall, truth_edges
from edgewatch.operators.evaluate import method_comparison
from edgewatch.operators.scoring import score_edges


def evaluate_batch(events: DataFrame, window: int = 10, threshold: float = 2.5) -> DataFrame:
    """Precision and recall of the z-score baseline."""
    return precision_recall(truth_edges(events), batch=zscore_flags(events, window, threshold))


def compare_detectors(
    events: DataFrame,
    cfg: ScorerConfig,
    window: int = 10,
    threshold: float = 2.5,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Baseline and scorer, one row each."""
    scores = score_rows(score_edges(events, cfg), ingested_at)
    return method_comparison(truth_edges(events), zscore_flags(events, window, threshold), scores)

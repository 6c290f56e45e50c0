"""Anomaly analytics over streams of directed edges, as PySpark DataFrame operators."""

from edgewatch.config import ScorerConfig

__all__ = ["ScorerConfig"]

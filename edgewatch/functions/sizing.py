"""Joins whose small side has a known bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000


def join_sized(
    df: DataFrame,
    other: DataFrame,
    on: list[str],
    row_bound: int,
    how: str = "inner",
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join with ``other``, which is known to hold at most ``row_bound`` narrow rows.

    Within ``limit`` it is broadcast; above it is a shuffle join, whose hot keys AQE splits.
    """
    if row_bound <= limit:
        other = F.broadcast(other)
    return df.join(other, on, how)

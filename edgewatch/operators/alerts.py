"""Rows of the ``scores`` and ``alerts`` tables, and alert messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewatch.functions.scalar import uuid_from

TEST_SOURCE = "test_src"


def score_rows(scored: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """The ``scores`` table; ``ingested_at`` defaults to the time of the query."""
    label = F.col("label") if "label" in scored.columns else F.lit(None)
    return scored.select(
        F.col("event_id").alias("id"),
        "src",
        "dst",
        F.timestamp_seconds("timestamp").alias("event_time"),
        F.col("score").alias("anomaly_score"),
        "is_alert",
        label.cast("smallint").alias("label"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )


def alert_rows(
    scored: DataFrame,
    stream: str = "edges",
    subgraph_nodes: Column | None = None,
    created_at: Column | None = None,
) -> DataFrame:
    """The ``alerts`` table, plus ``event_id``. The id depends on stream and event, so reruns agree."""
    nodes = F.array("src", "dst") if subgraph_nodes is None else subgraph_nodes
    return scored.filter("is_alert").select(
        uuid_from(F.lit(stream), F.col("event_id")).alias("alert_id"),
        "src",
        "dst",
        F.timestamp_seconds("timestamp").alias("event_time"),
        "score",
        nodes.alias("subgraph_nodes"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        "event_id",
    )


def alert_messages(alerts: DataFrame) -> DataFrame:
    """``alert_id, value`` where ``value`` is the JSON envelope sent to listeners."""
    data = F.struct(
        "alert_id",
        "src",
        "dst",
        F.unix_seconds("event_time").alias("timestamp"),
        "score",
        "subgraph_nodes",
    )
    body = F.struct(F.lit("alert").alias("type"), data.alias("data"))
    return alerts.select("alert_id", F.to_json(body).alias("value"))


def without_test_rows(df: DataFrame, test_source: str = TEST_SOURCE) -> DataFrame:
    return df.filter(F.col("src") != test_source)


def alerts_in_order(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy("event_time", "event_id")

"""Live-view aggregates over alerts: rate, feed and the alert graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEED_SIZE = 12
VISIBLE_EDGES = 55
VISIBLE_NODES = 45


def alert_rate(alerts: DataFrame, seconds: int = 1) -> DataFrame:
    """``second, alerts``: alerts in the trailing ``[t - seconds, t]`` at every second with an alert.

    Counts per second are added to the following seconds they are still visible in, so no window
    runs over the whole stream.
    """
    per_second = alerts.groupBy(F.unix_seconds("event_time").alias("second")).agg(
        F.count(F.lit(1)).alias("n")
    )
    shifts = F.explode(F.array(*[F.lit(i) for i in range(seconds + 1)])).alias("shift")
    spread = per_second.select("second", "n", shifts).select(
        (F.col("second") + F.col("shift")).alias("second"),
        "n",
        (F.col("shift") == 0).alias("own"),
    )
    return (
        spread.groupBy("second")
        .agg(F.sum("n").alias("alerts"), F.max("own").alias("own"))
        .filter("own")
        .drop("own")
    )


def alert_feed(alerts: DataFrame, size: int = FEED_SIZE) -> DataFrame:
    """The newest alerts, newest first."""
    return alerts.orderBy(F.desc("event_time"), F.desc("event_id")).limit(size)


def alert_graph_edges(alerts: DataFrame, limit: int | None = VISIBLE_EDGES) -> DataFrame:
    """``source, target, score, alerts``: each alerted edge with its latest score.

    A display keeps the ``limit`` edges that were first alerted last.
    """
    return _visible(_alerted_edges(alerts), limit).drop("_first")


def _alerted_edges(alerts: DataFrame) -> DataFrame:
    place = F.struct("event_time", "event_id")
    return alerts.groupBy(F.col("src").alias("source"), F.col("dst").alias("target")).agg(
        F.max_by("score", place).alias("score"),
        F.count(F.lit(1)).alias("alerts"),
        F.min(place).alias("_first"),
    )


def _visible(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.orderBy(F.desc("_first")).limit(limit)


def alert_graph_nodes(
    alerts: DataFrame,
    limit: int | None = VISIBLE_NODES,
    edge_limit: int | None = VISIBLE_EDGES,
) -> DataFrame:
    """``node, out_degree, in_degree, degree, role, alerted`` of the visible alert graph.

    A display keeps the ``limit`` nodes first alerted last; degrees count its visible edges.
    """
    ends = F.array(
        F.struct(F.col("source").alias("node"), F.lit(0).alias("end")),
        F.struct(F.col("target").alias("node"), F.lit(1).alias("end")),
    )
    # an edge meets its nodes at its first alert, so alerts shrink to edges before they are doubled;
    # both branches start from the same grouping, which is computed once
    grouped = _alerted_edges(alerts).select("source", "target", "_first")
    nodes = (
        grouped.select(F.col("_first").alias("at"), F.inline(ends))
        .groupBy("node")
        .agg(F.min(F.struct("at", "end")).alias("_first"))
    )
    nodes = _visible(nodes, limit)
    edges = _visible(grouped, edge_limit).select("source", "target")
    sides = F.array(
        F.struct(F.col("source").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("target").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )
    degrees = (
        edges.select(F.inline(sides))
        .groupBy("node")
        .agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))
    )
    out_degree = F.coalesce(F.col("out_degree"), F.lit(0))
    in_degree = F.coalesce(F.col("in_degree"), F.lit(0))
    role = (
        F.when(out_degree > in_degree + 1, "source")
        .when(in_degree > out_degree + 1, "sink")
        .otherwise("balanced")
    )
    return nodes.join(degrees, "node", "left").select(
        "node",
        out_degree.alias("out_degree"),
        in_degree.alias("in_degree"),
        (out_degree + in_degree).alias("degree"),
        role.alias("role"),
        F.col("out_degree").isNotNull().alias("alerted"),
    )

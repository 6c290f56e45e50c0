"""Connected components of an undirected graph by alternating stars; no vertex list leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewatch.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every vertex to the least of them and itself.

    The large star moves the neighbours above the vertex, the small star those below it.
    """
    # edges run from the greater end ``a`` to the smaller ``b``
    if large:
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        ways = edges
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = ways.join(least, "a")
    if large:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        below = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = below.unionByName(least.select("a", F.col("least").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def _is_settled(edges: DataFrame) -> bool:
    """Whether all edges end at vertices from which none starts, one for each vertex that has any."""
    ends = F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("starts")), F.struct(F.col("b").alias("v"), F.lit(0).alias("starts")))
    vertices = edges.select(F.inline(ends)).groupBy("v").agg(F.sum("starts").alias("starts"), F.min("starts").alias("least"))
    return vertices.filter("starts > 1 OR (starts > 0 AND least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``a, b``: every vertex that is not the least of its component, and that least vertex.

    ``edges`` has ``a, b`` of one type, in any direction; loops and repeated edges are allowed.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.filter(F.col("a") != F.col("b")).distinct(), "edges")
    while not _is_settled(edges):
        edges = materialize(_star(_star(edges, large=True), large=False), "stars")
    return edges

"""The alert graph as a display holds it: bounded, in order of entry, with eviction and re-entry.

Alerts reach the display in flushes. A flush adds its edges behind those that are shown, a known edge keeps
its place and takes the new score, and then all but the last ``limit`` edges leave. One that left and is
alerted again enters anew. What is shown in the end depends on the whole sequence.

The flushes, already reduced to one row per flush and edge, are cut into slices. All slices are replayed at
once from an empty display; then every slice whose entry differs from what the slice before has left is
replayed again, until none is left. Once a slice has shown ``limit`` new edges its end no longer depends on
its entry, so two rounds are usual; at worst there are as many rounds as slices.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewatch.operators.monitor import VISIBLE_EDGES, VISIBLE_NODES
from edgewatch.session import materialize, release

SLICE_ROWS = 100_000
ENTRY = "key1 string, key2 string, score double"
STATE = f"slice int, entries array<struct<{ENTRY.replace(' string', ': string').replace(' double', ': double')}>>"


def replay_flushes(shown: dict, rows: Iterable[tuple], limit: int) -> dict:
    """The display after rows ``flush, key, value`` in order; ``shown`` is what it held before."""
    shown, now = dict(shown), None
    for flush, key, value in rows:
        if flush != now:
            _evict(shown, limit)
            now = flush
        shown[key] = value
    _evict(shown, limit)
    return shown


def _evict(shown: dict, limit: int) -> None:
    for key in list(shown)[: max(len(shown) - limit, 0)]:
        del shown[key]


def _final_view(rows: DataFrame, limit: int) -> DataFrame:
    """``place, key1, key2, score`` of what is shown at last. ``rows`` has ``flush, key1, key2, place, score``."""
    per_flush = rows.groupBy("flush", "key1", "key2").agg(
        F.min("place").alias("place"), F.max_by("score", "place").alias("score")
    )
    per_flush = materialize(per_flush, "flushes")
    slices = max(1, -(-per_flush.count() // SLICE_ROWS))
    cut = per_flush.repartitionByRange(slices, "flush").withColumn("slice", F.spark_partition_id())
    cut = materialize(cut, "slices")
    release(per_flush)
    numbers = cut.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).select("slice")
    # slices without rows pass on what they get, so the list of the others is numbered anew
    names = [r["slice"] for r in numbers.orderBy("slice").collect()]
    following = dict(zip(names, names[1:]))

    def replay(frame: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        if frame.empty:
            return pd.DataFrame(columns=["slice", "entries"])
        given = entry["entries"].iloc[0] if len(entry) else ()
        shown = {(e["key1"], e["key2"]): e["score"] for e in given}
        order = sorted(zip(frame["flush"], map(_order, frame["place"]), frame["key1"], frame["key2"], frame["score"]), key=lambda r: r[:2])
        shown = replay_flushes(shown, ((flush, (a, b), score) for flush, _, a, b, score in order), limit)
        held = [{"key1": a, "key2": b, "score": score} for (a, b), score in shown.items()]
        return pd.DataFrame({"slice": [frame["slice"].iloc[0]], "entries": [held]})

    spark = rows.sparkSession
    entries = spark.createDataFrame([], STATE)
    again, ends = cut, None
    while True:
        new = again.groupBy("slice").cogroup(entries.groupBy("slice")).applyInPandas(replay, STATE)
        if ends is not None:
            new = new.unionByName(ends.join(again.select("slice").distinct(), "slice", "left_anti"))
        ends = materialize(new, "ends")
        if len(names) < 2:
            break
        step = spark.createDataFrame(list(following.items()), "slice int, following int")
        given = ends.join(F.broadcast(step), "slice").select(F.col("following").alias("slice"), "entries")
        old = entries.select("slice", F.col("entries").alias("before"))
        differs = ~F.col("entries").eqNullSafe(F.coalesce("before", F.array().cast(STATE.split("entries ")[1])))
        moved = materialize(given.join(old, "slice", "left").select("slice", "entries", differs.alias("differs")), "entries")
        entries = moved.drop("differs")
        changed = moved.filter("differs").select("slice")
        if changed.isEmpty():
            break
        again = cut.join(changed, "slice", "left_semi")
    last = ends.filter(F.col("slice") == (names[-1] if names else -1))
    return last.select(F.posexplode("entries").alias("place", "e")).select("place", "e.*")


def _order(place) -> tuple:
    """A struct of (time, id, end) that arrives as a row or a dictionary."""
    return tuple(place.values()) if isinstance(place, dict) else tuple(place)


def _flush(seconds: int) -> Column:
    return F.floor(F.unix_seconds("event_time") / seconds).cast("long")


def live_graph_edges(alerts: DataFrame, limit: int = VISIBLE_EDGES, flush_seconds: int = 1) -> DataFrame:
    """``place, source, target, score`` of the edges on display after all alerts; the last has entered last.

    Alerts without a source or target are not drawn.
    """
    rows = alerts.filter("src IS NOT NULL AND dst IS NOT NULL").select(
        _flush(flush_seconds).alias("flush"), F.col("src").alias("key1"), F.col("dst").alias("key2"),
        F.struct(F.unix_micros("event_time").alias("time"), "event_id", F.lit(0).alias("end")).alias("place"), "score",
    )
    return _final_view(rows, limit).select("place", F.col("key1").alias("source"), F.col("key2").alias("target"), "score")


def live_graph_nodes(alerts: DataFrame, limit: int = VISIBLE_NODES, flush_seconds: int = 1) -> DataFrame:
    """``place, node`` of the nodes on display after all alerts; an alert's source enters before its target."""
    ends = F.array(F.struct(F.col("src").alias("node"), F.lit(0).alias("end")), F.struct(F.col("dst").alias("node"), F.lit(1).alias("end")))
    rows = alerts.select(_flush(flush_seconds).alias("flush"), "event_time", "event_id", F.inline(ends)).filter("node IS NOT NULL")
    rows = rows.select(
        "flush", F.col("node").alias("key1"), F.lit("").alias("key2"),
        F.struct(F.unix_micros("event_time").alias("time"), "event_id", "end").alias("place"), F.lit(0.0).alias("score"),
    )
    return _final_view(rows, limit).select("place", F.col("key1").alias("node"))

"""Counters that fade with the time since an entity was last seen, one clock per entity.

The scorer's counters decay when the stream's clock enters a new tick, for all entities at once. Here an
entity's current count fades by ``alpha`` per tick length since its own last event, whatever others do.
Entities are dealt into buckets by hash; the counters of a bucket are one value of Structured Streaming's
state store, read and written once in a micro-batch, since each call of the store and each group of rows
costs a round trip between Python and the JVM. An entity that was silent for more than ``forget_seconds``
is new when it comes back; a timer of event time per bucket removes the counters of such entities.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from edgewatch.config import ScorerConfig

#: The state store that keeps such state; the session's setting must name it before the query starts.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: An entry of each array per edge of the bucket, and when the bucket's timer is due.
STATE = (
    "src array<string>, dst array<string>, first array<bigint>, last array<bigint>, "
    "current array<double>, total array<bigint>, due bigint"
)
#: A micro-batch rewrites the buckets it touches, and calls Python once for each.
BUCKETS = 1024
COUNTED = "event_id bigint, src string, dst string, timestamp bigint, current double, total bigint, age_ticks bigint, score double"


def faded(current: float, seconds: int, alpha: float, tick_seconds: int) -> float:
    """A count after some time without events."""
    return current * alpha ** (seconds / tick_seconds) if seconds > 0 else current


def deviation(current: float, total: int, ticks: int) -> float:
    """Chi-squared distance of the current count from the mean per tick; 0 in the first tick."""
    if ticks <= 1:
        return 0.0
    gap = current - total / ticks
    return gap * gap * ticks * ticks / (total * (ticks - 1))


class EntityClocks(StatefulProcessor):
    """Counts the events of the edges of one bucket; the rows of a batch in order of time, then id."""

    def __init__(self, alpha: float, tick_seconds: int, forget_seconds: int):
        self.alpha, self.tick_seconds, self.forget_seconds = alpha, tick_seconds, forget_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("counters", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        counters, due = self._held()
        out = []
        for at, event_id, edge in sorted((e for part in rows for e in _events(part)), key=_in_order):
            first, last, current, total = counters.get(edge) or (at, at, 0.0, 0)
            if at > last + self.forget_seconds:  # the timer may not have come yet
                first, last, current, total = at, at, 0.0, 0
            current = faded(current, at - last, self.alpha, self.tick_seconds) + 1
            last, total = max(last, at), total + 1
            ticks = max(at - first, 0) // self.tick_seconds + 1
            counters[edge] = first, last, current, total
            out.append((event_id, *edge, at, current, total, ticks, deviation(current, total, ticks)))
        self._keep(counters, due, timerValues)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in COUNTED.split(", ")], dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        counters, _ = self._held()
        self._keep(counters, None, timerValues)
        return iter(())

    def close(self) -> None:
        pass

    def _held(self) -> tuple[dict, int | None]:
        """The counters ``(first, last, current, total)`` by edge, and when the timer is due."""
        held = self.state.get()
        if held is None:
            return {}, None
        src, dst, *values, due = held
        return dict(zip(zip(src, dst, strict=True), zip(*values, strict=True), strict=True)), due

    def _keep(self, counters: dict, due: int | None, timerValues) -> None:
        """Store the counters of edges that are not forgotten, with a timer for the next one to forget."""
        now = timerValues.getCurrentWatermarkInMs()
        counters = {edge: c for edge, c in counters.items() if (c[1] + self.forget_seconds) * 1000 > now}
        following = (min(c[1] for c in counters.values()) + self.forget_seconds) * 1000 if counters else None
        if due != following:
            if due is not None:
                self.handle.deleteTimer(due)
            if following is not None:
                self.handle.registerTimer(following)
        if not counters:
            self.state.clear()
            return
        edges = [list(c) for c in zip(*counters, strict=True)]
        values = [list(c) for c in zip(*counters.values(), strict=True)]
        self.state.update((*edges, *values, following))


def _events(part: pd.DataFrame) -> Iterator[tuple]:
    """Time, id and edge of each row; what is missing is None. By columns, since a bucket's frames are small."""
    ids = zip(part["event_id"].tolist(), part["has_id"].tolist(), strict=True)
    src, dst = ([None if pd.isna(x) else x for x in part[c].tolist()] for c in ("src", "dst"))
    return zip(part["timestamp"].tolist(), (i if known else None for i, known in ids), zip(src, dst, strict=True), strict=True)


def _in_order(event: tuple) -> tuple:
    """By time, then id; an event without an id comes last."""
    at, event_id, _ = event
    return at, event_id is None, event_id


def count_with_entity_clocks(
    events: DataFrame, cfg: ScorerConfig, forget_seconds: int = 86_400, delay: str = "10 seconds", buckets: int = BUCKETS
) -> DataFrame:
    """A stream of edge events with each edge's own fading count, total, age in ticks and score.

    Events more than ``delay`` behind the newest are left out. ``event_id`` is a unique whole number. A query
    that is started again from its checkpoint must be given the same number of ``buckets``; more of them make
    a bucket's state smaller where a stream has many edges.
    """
    timed = events.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", delay)
    clocks = EntityClocks(cfg.alpha, cfg.tick_seconds, forget_seconds)
    bucket = F.pmod(F.xxhash64("src", "dst"), F.lit(buckets)).cast("int").alias("bucket")
    # pandas would turn the whole column into floats for a single missing id
    ids = F.coalesce("event_id", F.lit(0).cast("bigint")).alias("event_id"), F.col("event_id").isNotNull().alias("has_id")
    keyed = timed.select(bucket, "src", "dst", "timestamp", *ids, "event_time").groupBy("bucket")
    return keyed.transformWithStateInPandas(clocks, outputStructType=COUNTED, outputMode="Append", timeMode="EventTime")

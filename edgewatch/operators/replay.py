"""Replaying stored records as an event stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from edgewatch.functions.ordering import smallest_per_group
from edgewatch.functions.scalar import named
from edgewatch.operators.edges import MISSING_ADDRESS
from edgewatch.schemas import REPLAY_CORE_COLUMNS


def replay_timeline(
    df: DataFrame,
    rate: int,
    start: int,
    limit: int | None = None,
    row_idx: str = "row_idx",
    column: str = "timestamp",
) -> DataFrame:
    """Give row ``i`` the second it is sent in when ``rate`` rows are sent per second."""
    if rate <= 0:
        raise ValueError("rate must be greater than zero")
    if limit is not None:
        df = df.filter(F.col(row_idx) < limit)
    sent = F.floor(F.col(row_idx) / F.lit(rate)).cast("bigint")
    return df.withColumn(column, F.lit(start).cast("bigint") + sent)


def replay_live(
    rows: DataFrame, rate: int, send: Callable[[DataFrame, int], None], checkpoint: str, row_idx: str = "row_idx"
) -> StreamingQuery:
    """Send ``rate`` rows a second, in the order of ``row_idx``, to ``send(rows, batch_id)`` as time passes.

    A rate source says up to which number rows are due; a batch takes the rows of its numbers by a range
    filter, which a table sorted by ``row_idx`` answers from few row groups. The query goes on where its
    checkpoint says, and ends when it is stopped; numbers beyond the last row send nothing.
    """
    if rate <= 0:
        raise ValueError("rate must be greater than zero")

    def due(ticks: DataFrame, batch_id: int) -> None:
        low, high = ticks.agg(F.min("value"), F.max("value")).first()
        if low is not None:
            send(rows.filter(F.col(row_idx).between(low, high)), batch_id)

    ticks = rows.sparkSession.readStream.format("rate").option("rowsPerSecond", rate).load()
    return ticks.writeStream.foreachBatch(due).option("checkpointLocation", checkpoint).start()


def sample_rows(df: DataFrame, n: int, order: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows picked by a seeded hash of ``order``, the same ones in every run."""
    grouped = df.withColumn("_group", F.lit(0))
    key = F.xxhash64(F.lit(seed), *order)
    return smallest_per_group(grouped, "_group", key, n, *order).drop("_group")


def sample_per_file(
    df: DataFrame, group: str, n: int, order: list[str], seed: int = 42
) -> DataFrame:
    """At most ``n`` rows per group, picked by a seeded hash; smaller groups are kept whole."""
    return smallest_per_group(df, group, F.xxhash64(F.lit(seed), *order), n, *order)


def _address(df: DataFrame, column: str) -> Column:
    if column not in df.columns:
        return F.lit(MISSING_ADDRESS)
    return F.coalesce(named(column).cast("string"), F.lit(MISSING_ADDRESS))


def _feature_columns(df: DataFrame, extra: tuple[str, ...]) -> list[str]:
    skipped = {*REPLAY_CORE_COLUMNS, *extra}
    return [c for c in df.columns if c not in skipped]


def _core(flows: DataFrame, sent_at: Column) -> list[Column]:
    label = F.col("is_attack").cast("int") if "is_attack" in flows.columns else F.lit(None).cast("int")
    kind = F.col("attack_type") if "attack_type" in flows.columns else F.lit(None).cast("string")
    return [
        _address(flows, "Source IP").alias("src"),
        _address(flows, "Destination IP").alias("dst"),
        sent_at.alias("timestamp"),
        label.alias("label"),
        kind.alias("attack_type"),
    ]


def _sent_at(flows: DataFrame, rate: int, start: int, preserve: bool, row_idx: str) -> Column:
    if rate <= 0:
        raise ValueError("rate must be greater than zero")
    paced = F.lit(start).cast("bigint") + F.floor(F.col(row_idx) / F.lit(rate)).cast("bigint")
    if preserve and "Timestamp" in flows.columns:
        return F.unix_seconds(F.col("Timestamp").cast("timestamp"))
    return paced


def replay_events(
    flows: DataFrame,
    rate: int = 100,
    start: int = 0,
    preserve_timestamps: bool = False,
    row_idx: str = "row_idx",
) -> DataFrame:
    """Flow records as edge events; every other column that is a number goes into ``features``."""
    names = _feature_columns(flows, (row_idx,))
    sent_at = _sent_at(flows, rate, start, preserve_timestamps, row_idx)
    pairs = [x for c in names for x in (F.lit(c), named(c).try_cast("double"))]
    features = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
    kept = F.map_filter(features, lambda _, v: v.isNotNull())
    return flows.select(F.col(row_idx), *_core(flows, sent_at), kept.alias("features"))


def replay_json(
    flows: DataFrame,
    rate: int = 100,
    start: int = 0,
    preserve_timestamps: bool = False,
    row_idx: str = "row_idx",
) -> DataFrame:
    """``row_idx, value``: the events as flat JSON objects, one key per core field and feature."""
    names = _feature_columns(flows, (row_idx,))
    sent_at = _sent_at(flows, rate, start, preserve_timestamps, row_idx)
    fields = [*_core(flows, sent_at), *[named(c).try_cast("double").alias(c) for c in names]]
    return flows.select(F.col(row_idx), F.to_json(F.struct(*fields)).alias("value"))


def edges_json(edges: DataFrame, key: str = "row_idx") -> DataFrame:
    """``key, value``: edge events as JSON; ``label`` is left out where it is null."""
    fields = [c for c in ("src", "dst", "timestamp", "label") if c in edges.columns]
    return edges.select(key, F.to_json(F.struct(*fields)).alias("value"))

"""Edge scoring: chi-squared of an edge, its source and its destination against their own history.

The sequential definition takes events one by one: at the first event of a new tick all current
counters decay, the event is then added to the current and total counters of its edge, source and
destination, and each is scored. Here the same numbers come from

1. counts per edge and tick, summed on to sources and destinations (small, pre-aggregated),
2. a fold over each entity's ticks that gives its counters at the start of every tick,
3. the position of each event among the events of the same entity and tick.

Work is split by (entity, tick), so an entity that holds much of the stream is spread over its
ticks; a tick with more than ``SLICE_ROWS`` events is further cut into slices of stream order. Exact
counters without a filter need slices only where one source or destination has that many in a tick.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgewatch.config import ScorerConfig
from edgewatch.functions.ordering import dense_ranks
from edgewatch.functions.scalar import chi_squared_sql, named, tick_of
from edgewatch.functions.sizing import join_sized
from edgewatch.operators.decay_fold import fold_counts
from edgewatch.operators.sketch import cell_ids
from edgewatch.operators.sketch_fold import place_batches
from edgewatch.session import materialize, release

SLICE_ROWS = 1_000_000
TICK_BLOCK = 4096
SETTLED_SHARE = 0.2

KINDS = ("edge", "src", "dst")
#: The columns of a scored event, in order.
SCORE_COLUMNS = (
    "score",
    "is_alert",
    "timestamp",
    "edge_score",
    "src_score",
    "dst_score",
    "edge_current",
    "edge_total",
    "src_current",
    "src_total",
    "dst_current",
    "dst_total",
    "tick",
    "expected_edge",
    "src",
    "dst",
)


@dataclass(frozen=True)
class Clock:
    """Where the stream stands: its first timestamp, newest tick, and number of ticks seen."""

    start: int
    max_tick: int = 0
    max_rank: int = 0


@dataclass(frozen=True)
class StreamProfile:
    """Extents of a set of events, from one aggregate over three columns."""

    rows: int
    first: int
    low: int
    high: int


def profile_events(events: DataFrame, cfg: ScorerConfig) -> StreamProfile:
    """Row count and extents; ``first`` is the timestamp of the first event in stream order."""
    first = F.min("timestamp") if cfg.order == "event_time" else F.min_by("timestamp", cfg.arrival)
    row = events.agg(
        F.count(F.lit(1)).alias("rows"),
        first.alias("first"),
        F.min("timestamp").alias("low"),
        F.max("timestamp").alias("high"),
    ).first()
    return StreamProfile(**{k: (0 if v is None else int(v)) for k, v in row.asDict().items()})


def stream_order(cfg: ScorerConfig) -> list[str]:
    return ["timestamp", "event_id"] if cfg.order == "event_time" else [cfg.arrival]


def assign_ticks(
    events: DataFrame, cfg: ScorerConfig, profile: StreamProfile, clock: Clock
) -> DataFrame:
    """Add ``tick``, from the event's own timestamp, and ``_at``, the tick its counts go to.

    They differ for late events only: those count towards the newest tick seen before them.
    """
    ticked = events.withColumn("tick", tick_of(F.col("timestamp"), clock.start, cfg.tick_seconds))
    newest = F.greatest(F.col("tick"), F.lit(clock.max_tick))
    if cfg.order == "event_time":
        return ticked.withColumn("_at", newest.cast("bigint"))
    return _with_newest_tick(ticked, cfg, profile, clock)


def _with_newest_tick(
    ticked: DataFrame, cfg: ScorerConfig, profile: StreamProfile, clock: Clock
) -> DataFrame:
    """Arrival order: ``_at`` is the running maximum of the ticks.

    An event is late if the first event of a later tick came before it, which the first arrivals of the
    ticks tell. Only late events are put in order, by range partitioning, together with the first event
    of each tick that was the newest when it came.
    """
    firsts = ticked.groupBy("tick").agg(F.min(cfg.arrival).alias("_first"))
    firsts = firsts.withColumn("_block", F.floor(F.col("tick") / TICK_BLOCK))
    later = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_block").orderBy(F.desc("tick")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = firsts.groupBy("_block").agg(F.min("_first").alias("_low"))
    blocks = blocks.select("_block", F.min("_low").over(later).alias("_beyond"))
    overtaken = F.least(F.min("_first").over(inside), F.col("_beyond"))
    ticks = firsts.join(blocks, "_block").select("tick", "_first", overtaken.alias("_overtaken"))
    ticks = materialize(ticks, "ticks")
    bound = (profile.high - profile.low) // cfg.tick_seconds + 2
    joined = join_sized(ticked, ticks.select("tick", "_overtaken"), ["tick"], bound)
    is_late = F.coalesce(F.col(cfg.arrival) > F.col("_overtaken"), F.lit(False))
    open_tick = F.lit(clock.max_tick)
    punctual = joined.filter(~is_late).withColumn("_at", F.greatest("tick", open_tick).cast("bigint"))

    newest = ticks.filter(F.col("_overtaken").isNull() | (F.col("_first") < F.col("_overtaken")))
    marks = newest.select(F.col("_first").alias(cfg.arrival), F.col("tick").alias("_top"))
    late = joined.filter(is_late).unionByName(marks, allowMissingColumns=True)
    late = late.repartitionByRange(cfg.arrival).withColumn("_part", F.spark_partition_id())
    late = materialize(late, "late")
    upto = Window.partitionBy("_part").orderBy(cfg.arrival).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    tops = late.groupBy("_part").agg(F.max("_top").alias("_top"))
    tops = tops.select("_part", F.max("_top").over(earlier).alias("_before"))
    running = F.greatest(F.max("_top").over(upto), F.col("_before"), F.col("tick"), open_tick)
    # one row per range partition
    late = late.join(F.broadcast(tops), "_part").withColumn("_at", running.cast("bigint"))
    columns = [*ticked.columns, "_at"]
    return punctual.select(columns).unionByName(late.filter("_top IS NULL").select(columns))


def with_slices(events: DataFrame, cfg: ScorerConfig, profile: StreamProfile) -> DataFrame:
    """Add ``_slice``: ticks with more than ``SLICE_ROWS`` events are cut into runs of stream order.

    The events of such ticks are sorted by range partitioning and numbered inside their tick: by place
    in the partition, after the partitions before. The slice is the number over ``SLICE_ROWS``.
    """
    if profile.rows <= SLICE_ROWS:  # then no tick has more
        return events.withColumn("_slice", F.lit(0))
    busy = events.groupBy("_at").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > SLICE_ROWS)
    busy = materialize(busy.select("_at"), "busy-ticks")
    if busy.isEmpty():
        return events.withColumn("_slice", F.lit(0))
    order = ["_at", *stream_order(cfg)]
    hot = events.join(busy, "_at").repartitionByRange(*order).sortWithinPartitions(*order)
    hot = hot.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    hot = materialize(hot, "busy")
    part = ["_at", "_part"]
    earlier = Window.partitionBy("_at").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = hot.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_low"))
    parts = parts.select(*part, "_low", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_row") - F.col("_low")
    hot = hot.join(parts, part).withColumn("_slice", F.floor(number / SLICE_ROWS).cast("int"))
    quiet = events.join(busy, "_at", "left_anti").withColumn("_slice", F.lit(0))
    return quiet.unionByName(hot.select(*quiet.columns))


def _ranked(counts: DataFrame, ranks: DataFrame, bound: int) -> DataFrame:
    return join_sized(counts, ranks, ["_at"], bound)


def _tick_ranks(counts: DataFrame, clock: Clock) -> DataFrame:
    """Rank of every observed tick. A tick already open keeps the rank it has."""
    # the (always true) test on the sums keeps this on the shuffled counts instead of a new scan
    seen = counts.groupBy("_at").agg(F.sum(F.col("n_cur") + F.col("n_tot")).alias("n"))
    seen = seen.filter((F.col("n") > 0) & (F.col("_at") > clock.max_tick)).select("_at")
    fresh = dense_ranks(seen, "_at")
    ranks = fresh.select("_at", (F.col("_rank") + clock.max_rank).cast("bigint").alias("_rank"))
    if clock.max_rank == 0:
        return ranks
    open_tick = (
        ranks.sparkSession.range(1)
        .select(F.lit(clock.max_tick).cast("bigint").alias("_at"), F.lit(clock.max_rank).cast("bigint").alias("_rank"))
    )
    return ranks.unionByName(open_tick)


def _earlier(at: int, number: int) -> Column:
    """Before a slice of a tick, in stream order."""
    return (F.col("_at") < at) | (F.col("_at") == at) & (F.col("_slice") < number)


COUNTER_KEYS = ["kind", "key1", "key2", "cell"]
VALUES = ["rank", "current", "total"]


@dataclass(frozen=True)
class Scoring:
    """A scored set of events and the counters it leaves behind.

    ``earlier`` are counters of entities that were settled before the events of ``folds``.
    """

    scored: DataFrame
    folds: dict[str, tuple[list[str], DataFrame]]
    earlier: DataFrame | None = None

    def counters(self, until: tuple[int, int] | None = None) -> DataFrame:
        """``(kind, key1, key2, cell, rank, current, total)`` after the last event of each entity.

        ``until`` takes only the events before that tick and slice.
        """
        parts = []
        for kind, (keys, fold) in self.folds.items():
            after = F.struct(
                F.col("_rank").alias("rank"),
                (F.col("cur0") + F.col("n_cur")).alias("current"),
                (F.col("tot0") + F.col("n_tot")).alias("total"),
            )
            if until is not None:
                fold = fold.filter(_earlier(*until))
            last = fold.groupBy(*keys).agg(
                F.max_by(after, F.struct("_rank", "_slice")).alias("s")
            )
            parts_of = {"edge": ("src", "dst"), "src": ("src", None), "dst": ("dst", None)}
            key1, key2 = parts_of.get(kind, (None, None))
            missing = F.lit(None)
            parts.append(
                last.select(
                    F.lit(kind).alias("kind"),
                    (F.col(key1) if key1 else missing).cast("string").alias("key1"),
                    (F.col(key2) if key2 else missing).cast("string").alias("key2"),
                    (F.col("_cell") if kind == "cell" else missing).cast("bigint").alias("cell"),
                    "s.*",
                )
            )
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        if self.earlier is None:
            return out
        # an entity's own events come after what was settled
        both = out.withColumn("_new", F.lit(1)).unionByName(self.earlier.withColumn("_new", F.lit(0)))
        newest = F.max_by(F.struct("rank", "current", "total"), "_new").alias("s")
        return both.groupBy(*COUNTER_KEYS).agg(newest).select(*COUNTER_KEYS, "s.*")


def _with_state(counts: DataFrame, keys: list[str], kind: str, state: DataFrame | None) -> DataFrame:
    """Put the counters carried in from earlier events in front of an entity's counts."""
    if state is None:
        return counts
    sources = {"edge": ["key1", "key2"], "src": ["key1"], "dst": ["key1"], "cell": ["cell"]}[kind]
    carried = state.filter(F.col("kind") == kind).select(
        *[F.col(s).alias(k) for s, k in zip(sources, keys)], *VALUES, *(["batch"] if "batch" in state.columns else [])
    )
    # only entities of this batch are needed; the rest keep the counters they have
    touched = counts.select(*[F.col(k).alias(f"_touched_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:  # a null id is an entity like any other
        same &= F.col(k).eqNullSafe(F.col(f"_touched_{k}"))
    carried = carried.join(touched, same, "left_semi")
    if "batch" in carried.columns:  # the counters of several batches: the newest hold
        carried = carried.groupBy(*keys).agg(F.max_by(F.struct(*VALUES), "batch").alias("s")).select(*keys, "s.*")
    carried = carried.select(
        *keys,
        F.lit(0).cast("bigint").alias("_at"),
        F.lit(-1).alias("_slice"),
        F.col("current").alias("n_cur"),
        F.col("total").alias("n_tot"),
        F.col("rank").alias("_rank"),
    )
    return counts.unionByName(carried)


def _sums(df: DataFrame, keys: list[str]) -> DataFrame:
    sums = F.expr("sum(n_cur) AS n_cur"), F.expr("sum(n_tot) AS n_tot")
    return df.groupBy(*keys, "_at", "_slice").agg(*sums)


def _score_columns(df: DataFrame, cfg: ScorerConfig, payload: list[str]) -> DataFrame:
    scores = [f"{chi_squared_sql(f'{k}_current', f'{k}_total', 'tick')} AS {k}_score" for k in KINDS]
    return (
        df.selectExpr("*", *scores, "edge_total / tick AS expected_edge")
        .selectExpr("*", "greatest(edge_score, src_score, dst_score) AS score")
        .withColumn("is_alert", F.col("score") >= F.lit(float(cfg.threshold)))
        .select(*SCORE_COLUMNS, *payload)
    )


def _place_events(
    events: DataFrame,
    groups: list[tuple[str, list[str], DataFrame]],
    order: list[str],
    all_kept: bool,
) -> DataFrame:
    """Give each event its counters, for groups nested in one another, with a single shuffle.

    The counters of a group travel as one marker row that sorts before its events, so no join with
    the events is needed: a running sum starts from the marker's counters and adds the events. An
    entity without history needs no marker.
    """
    last = len(groups)
    mixed = events.selectExpr("*", f"{last} AS _mark")
    columns = []
    for i, (kind, keys, fold) in enumerate(groups):
        marker = fold.filter("_slice >= 0 AND (cur0 > 0 OR tot0 > 0)").selectExpr(
            *keys,
            "_at",
            "_slice",
            f"{i} AS _mark",
            f"cur0 AS _{kind}_cur0",
            f"tot0 AS _{kind}_tot0",
        )
        mixed = mixed.unionByName(marker, allowMissingColumns=True)
        # shared leading columns let nested groups use one partitioning
        running = (
            f"OVER (PARTITION BY _at, _slice, {', '.join(keys)} ORDER BY _mark, {', '.join(order)} "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        )
        kept = "1" if all_kept else "if(_keep, 1, 0)"
        # the event itself always counts, whether or not later events will see it
        own = "" if all_kept else " + if(_keep, 0, 1)"
        columns += [
            f"sum(if(_mark = {last}, 1, coalesce(_{kind}_cur0, 0))) {running} AS {kind}_current",
            f"sum(if(_mark = {last}, {kept}, coalesce(_{kind}_tot0, 0))) {running}{own}"
            f" AS {kind}_total",
        ]
    placed = mixed.selectExpr(*[f"`{c}`" for c in events.columns], "_mark", *columns)
    return placed.filter(f"_mark = {last}").drop("_mark")


ENTITIES = {"edge": ["src", "dst"], "src": ["src"], "dst": ["dst"]}


def _edge_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("src", "dst", "_at", "_slice").agg(
        F.count(F.lit(1)).alias("n_cur"), F.count_if("_keep").alias("n_tot")
    )


def _score_exact(
    events: DataFrame, cfg: ScorerConfig, clock: Clock, state: DataFrame | None, bound: int, payload: list[str]
) -> Scoring:
    edges = _edge_counts(events)
    ranks = _tick_ranks(edges, clock)
    floor = cfg.decay == "floor"
    folds = {}
    for kind, keys in ENTITIES.items():
        counts = edges if kind == "edge" else _sums(edges, keys)
        counts = _with_state(_ranked(counts, ranks, bound), keys, kind, state)
        folds[kind] = (keys, fold_counts(counts, keys, cfg.alpha, floor))
    return _scored_exact(events, cfg, folds, payload)


def _stored(df: DataFrame, label: str) -> DataFrame:
    return materialize(df, label, drop_shuffles=True, compression="zstd")


def _score_exact_large(
    ticked: DataFrame, cfg: ScorerConfig, profile: StreamProfile, clock: Clock, state: DataFrame | None, bound: int, payload: list[str]
) -> Scoring:
    """``_score_exact`` step by step: counts and folds are written once, so that the shuffles of each step
    are gone before the next one begins.

    The events are cut into slices, which copies those of busy ticks, only if a source or destination has
    more than ``SLICE_ROWS`` of them in a tick. An edge cannot have more than its source.
    """
    whole = ticked.withColumns({"_slice": F.lit(0), "_keep": F.lit(True)})
    counts = _entity_counts(whole)
    if any(not counts[kind].filter(F.col("n_cur") > SLICE_ROWS).isEmpty() for kind in ("src", "dst")):
        for stored in counts.values():
            release(stored)
        whole = with_slices(ticked, cfg, profile).withColumn("_keep", F.lit(True))
        counts = _entity_counts(whole)
    ranks = _stored(_tick_ranks(counts["edge"], clock), "ranks")
    folds = {}
    for kind, keys in ENTITIES.items():
        given = _with_state(_ranked(counts[kind], ranks, bound), keys, kind, state)
        folds[kind] = (keys, _stored(fold_counts(given, keys, cfg.alpha, cfg.decay == "floor"), f"{kind}-fold"))
        release(counts[kind])
    release(ranks)
    tick = tick_of(F.col("timestamp"), clock.start, cfg.tick_seconds)
    return _scored_exact(whole.drop("tick", "_keep"), cfg, folds, payload, tick)


def _entity_counts(events: DataFrame) -> dict[str, DataFrame]:
    edges = _stored(_edge_counts(events), "edge-counts")
    return {"edge": edges} | {kind: _stored(_sums(edges, [kind]), f"{kind}-counts") for kind in ("src", "dst")}


def _scored_exact(
    events: DataFrame, cfg: ScorerConfig, folds: dict[str, tuple[list[str], DataFrame]], payload: list[str], tick: Column | None = None
) -> Scoring:
    """With ``tick``, which events then lack, they are written once they have their places among sources and edges."""
    order = stream_order(cfg)
    every = not cfg.filter_anomalies
    nested = [("src", *folds["src"]), ("edge", *folds["edge"])]
    placed = _place_events(events, nested, order, every)
    if tick is not None:
        placed = _stored(placed, "placed")
    placed = _place_events(placed, [("dst", *folds["dst"])], order, every)
    if tick is not None:
        placed = placed.withColumn("tick", tick)
    return Scoring(_score_columns(placed, cfg, payload), folds)


def _score_sketch(
    events: DataFrame, cfg: ScorerConfig, clock: Clock, state: DataFrame | None, bound: int, payload: list[str]
) -> Scoring:
    edges = events.groupBy("src", "dst", "_at", "_slice").agg(
        F.count(F.lit(1)).alias("n_cur"), F.count_if("_keep").alias("n_tot")
    )
    ranks = _tick_ranks(edges, clock)
    cells = F.explode(_event_cells(cfg)).alias("_cell")
    # hashed once per edge and tick, then summed into at most 3 * depth * width cells per tick
    counts = _sums(edges.select("_at", "_slice", "n_cur", "n_tot", cells), ["_cell"])
    counts = _with_state(_ranked(counts, ranks, bound), ["_cell"], "cell", state)
    fold = fold_counts(counts, ["_cell"], cfg.alpha, cfg.decay == "floor")
    # one shuffle of the events: a slice's cells travel with it and sort before its events
    starts = fold.filter("_slice >= 0").select("_at", "_slice", F.lit(0).alias("_mark"), "_cell", "cur0", "tot0")
    mixed = events.select("*", F.lit(1).alias("_mark"), _event_cells(cfg).alias("_cells"))
    mixed = mixed.unionByName(starts, allowMissingColumns=True).repartition("_at", "_slice")
    mixed = mixed.sortWithinPartitions("_at", "_slice", "_mark", *stream_order(cfg))
    counter = T.LongType() if cfg.decay == "floor" else T.DoubleType()
    kinds = {"current": counter, "total": T.LongType()}
    added = [T.StructField(f"{kind}_{c}", t) for kind in KINDS for c, t in kinds.items()]
    place = place_batches(events.columns, KINDS, cfg.depth, cfg.width, cfg.decay == "floor")
    placed = mixed.mapInArrow(place, T.StructType([*events.schema.fields, *added]))
    return Scoring(_score_columns(placed, cfg, payload), {"cell": (["_cell"], fold)})


def _event_cells(cfg: ScorerConfig) -> Column:
    """The cells an event falls into: ``depth`` each for its edge, source and destination."""
    keys = (
        F.concat_ws("→", "src", "dst"),
        F.col("src"),
        F.col("dst"),
    )
    per_kind = []
    for i, key in enumerate(keys):
        per_kind += cell_ids(key, cfg, first_row=i * cfg.depth)
    return F.array(*per_kind)


def score_batch(
    events: DataFrame,
    cfg: ScorerConfig,
    clock: Clock | None = None,
    state: DataFrame | None = None,
    profile: StreamProfile | None = None,
) -> tuple[Scoring, Clock]:
    """Score events that follow ``clock`` and ``state``, and say where the stream then stands."""
    profile = profile or profile_events(events, cfg)
    clock = clock or Clock(profile.first)
    payload = [c for c in events.columns if c not in SCORE_COLUMNS]
    ticked = assign_ticks(events, cfg, profile, clock)
    top = max(1, (profile.high - clock.start) // cfg.tick_seconds + 1, clock.max_tick)
    low = max(1, (profile.low - clock.start) // cfg.tick_seconds + 1, clock.max_tick)
    bound = top - low + 2
    kernel = _score_exact if cfg.counts == "exact" else _score_sketch
    if cfg.filter_anomalies:
        result = _filter_to_fixed_point(with_slices(ticked, cfg, profile), cfg, clock, state, bound, payload, kernel)
    elif cfg.counts == "exact" and profile.rows > SLICE_ROWS:
        result = _score_exact_large(ticked, cfg, profile, clock, state, bound, payload)
    else:
        kept = with_slices(ticked, cfg, profile).withColumn("_keep", F.lit(True))
        result = kernel(kept, cfg, clock, state, bound, payload)
    return result, Clock(clock.start, top, clock.max_rank)


def _filter_to_fixed_point(ticked, cfg, clock, state, bound, payload, kernel) -> Scoring:
    """Leave events that score above the cut-off out of the totals that later events see.

    Which events those are depends on the scores of earlier ones only. A pass scores with the last
    pass's choice; everything before the first (tick, slice) in which the choice changes is then final.
    It is kept, its counters become state, and only the rest is scored again. Each pass settles at least
    one more event, is written to the shared folder once, and replaces the one before it.
    """
    inner = ["_at", "_slice", "_keep"]
    inputs = ["src", "dst", "timestamp", "tick", "_at", "_slice", *payload]
    outputs = [*SCORE_COLUMNS, *payload]
    current, last = ticked.withColumn("_keep", F.lit(True)), None
    keep = F.col("score") <= F.lit(float(cfg.filter_cutoff))
    settled, earlier, given = [], None, state
    while True:
        result = kernel(current, cfg, clock, state, bound, [*payload, *inner])
        scored = materialize(result.scored.withColumn("_next", keep), "filter")
        changed = scored.filter(F.col("_next") != F.col("_keep"))
        first = changed.agg(F.min(F.struct("_at", "_slice")).alias("f")).first().f
        if first is None:
            final = scored.select(*outputs)
            for part in settled:
                final = final.unionByName(part)
            return Scoring(final, result.folds, earlier)
        at, number = first
        before, rest = scored.filter(_earlier(at, number)), scored
        # settling costs a few small jobs: worth it when a good part of what is left has become final
        if SETTLED_SHARE * scored.count() <= before.count():
            settled.append(materialize(before.select(*outputs), "settled"))
            counters = Scoring(result.scored, result.folds, earlier).counters((at, number))
            earlier = materialize(counters, "settled-counters")
            state = _over(given, earlier)
            clock = _clock_after(result.folds, clock, (at, number))
            rest = materialize(scored.filter(~_earlier(at, number)), "filter")
            release(scored)
        if last is not None:
            release(last)
        last = rest
        current = rest.select(*[named(c) for c in inputs], F.col("_next").alias("_keep"))


def _over(state: DataFrame | None, newer: DataFrame) -> DataFrame:
    """Counters of ``newer`` in place of those of ``state``."""
    if state is None:
        return newer
    age = F.col("batch") if "batch" in state.columns else F.lit(0).cast("bigint")
    return newer.withColumn("batch", F.lit(2**62)).unionByName(state.withColumn("batch", age))


def _clock_after(folds: dict, clock: Clock, until: tuple[int, int]) -> Clock:
    """The clock at a (tick, slice): the newest tick with events before it, and that tick's rank."""
    _, fold = next(iter(folds.values()))
    ranks = fold.filter((F.col("_slice") >= 0) & _earlier(*until))
    row = ranks.agg(F.max(F.struct("_at", "_rank")).alias("t")).first().t
    return clock if row is None else Clock(clock.start, max(row[0], clock.max_tick), max(row[1], clock.max_rank))


def score_edges(events: DataFrame, cfg: ScorerConfig | None = None) -> DataFrame:
    """Score ``events(src, dst, timestamp, event_id, ...)``.

    ``event_id`` is a unique bigint; with ``order="arrival"`` events are ordered by the column that
    ``cfg.arrival`` names. Further columns such as ``label`` are passed through.
    """
    return score_batch(events, cfg or ScorerConfig())[0].scored

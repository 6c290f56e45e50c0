import math
import random

import pytest
from pyspark.sql import functions as F

from edgewatch.config import ScorerConfig
from edgewatch.operators import scoring
from edgewatch.operators.scoring import SCORE_COLUMNS, score_edges
from edgewatch.sources.streams import topic_events
from model import score_all
from traffic import burst_traffic

SCHEMA = "src string, dst string, timestamp bigint, event_id bigint"


def stream(seed, n=600, hot=0.35, late=0):
    """Random events with gaps, tied seconds, and one pair that holds a third of them."""
    rng = random.Random(seed)
    rows, now = [], 1_700_000_000
    for i in range(n):
        now += rng.choice([0, 0, 1, 1, 2, 5, 40 if rng.random() < 0.1 else 0])
        if rng.random() < hot:
            src, dst = "a", "z"
        else:
            src, dst = f"h{rng.randint(0, 12)}", f"h{rng.randint(0, 12)}"
        back = rng.randint(0, late) if late and rng.random() < 0.3 else 0
        rows.append((src, dst, now - back, i))
    return rows


def assert_same(scored, rows, cfg):
    expected = score_all(rows, cfg)
    got = {r.event_id: r for r in scored.collect()}
    assert len(got) == len(rows)
    for event_id, want in expected.items():
        row = got[event_id]
        for name, value in want.items():
            assert row[name] == pytest.approx(value, rel=1e-12, abs=1e-12), (event_id, name)
        assert row.is_alert == (row.score >= cfg.threshold)


CONFIGS = [
    ScorerConfig(tick_seconds=10),
    ScorerConfig(tick_seconds=3, alpha=0.5),
    ScorerConfig(tick_seconds=60, alpha=0.0),
    ScorerConfig(tick_seconds=10, alpha=0.7, decay="none"),
    ScorerConfig(tick_seconds=10, alpha=0.5, counts="sketch", width=5, depth=3, hash_fn="md5"),
    ScorerConfig(tick_seconds=10, alpha=0.5, filter_anomalies=True, filter_cutoff=2.0),
    ScorerConfig(
        tick_seconds=10, alpha=0.5, filter_anomalies=True, filter_cutoff=2.0,
        counts="sketch", width=7, depth=2, hash_fn="md5",
    ),
]


@pytest.mark.parametrize("cfg", CONFIGS, ids=range(len(CONFIGS)))
def test_equals_event_by_event(spark, cfg):
    rows = stream(1)
    assert_same(score_edges(spark.createDataFrame(rows, SCHEMA), cfg), rows, cfg)


@pytest.mark.parametrize(
    "cfg",
    [
        ScorerConfig(tick_seconds=10, alpha=0.6, order="arrival"),
        ScorerConfig(
            tick_seconds=10, alpha=0.6, order="arrival", filter_anomalies=True, filter_cutoff=1.0
        ),
    ],
    ids=["late", "late-filtered"],
)
def test_late_events_in_arrival_order(spark, monkeypatch, cfg):
    monkeypatch.setattr(scoring, "TICK_BLOCK", 3)
    rows = stream(2, late=90)
    assert_same(score_edges(spark.createDataFrame(rows, SCHEMA), cfg), rows, cfg)


def test_spread_ids_give_the_same_arrival_order(spark):
    cfg = ScorerConfig(tick_seconds=10, alpha=0.6, order="arrival")
    rows = [(*r[:3], r[3] << 22) for r in stream(2, late=90)]
    assert_same(score_edges(spark.createDataFrame(rows, SCHEMA), cfg), rows, cfg)


def test_records_of_two_partitions_in_time_order_are_not_late(spark):
    rows = [
        (f'{{"src": "a", "dst": "b{i % 3}", "timestamp": {1000 + i}, "label": 0}}', i % 2, i // 2, i) for i in range(60)
    ]
    raw = spark.createDataFrame(rows, "value string, partition int, offset long, ms int")
    raw = raw.withColumn("timestamp", F.timestamp_millis("ms")).drop("ms")
    events = topic_events(raw)
    scored = score_edges(events, ScorerConfig(tick_seconds=10, order="arrival", arrival="arrival"))
    by_time = score_edges(events.drop("arrival"), ScorerConfig(tick_seconds=10)).collect()
    got = {r.event_id: (r.score, r.tick, r.edge_total) for r in scored.collect()}
    assert got == {r.event_id: (r.score, r.tick, r.edge_total) for r in by_time}


def test_null_ids_keep_their_state(spark):
    rows = [(None if i % 3 else "a", "b", 1000 + i, i) for i in range(40)]
    cfg = ScorerConfig(tick_seconds=10, alpha=0.5)
    whole = {r.event_id: r.score for r in score_edges(spark.createDataFrame(rows, SCHEMA), cfg).collect()}
    first, clock = scoring.score_batch(spark.createDataFrame(rows[:20], SCHEMA), cfg)
    state = first.counters()
    clock = scoring.Clock(clock.start, clock.max_tick, state.agg({"rank": "max"}).first()[0])
    second, _ = scoring.score_batch(spark.createDataFrame(rows[20:], SCHEMA), cfg, clock, state)
    got = {r.event_id: r.score for part in (first, second) for r in part.scored.collect()}
    assert got == whole


def test_event_before_the_start_scores_zero(spark):
    cfg = ScorerConfig(tick_seconds=10, order="arrival")
    rows = [("a", "b", 1000, 0), ("a", "b", 1050, 1), ("a", "b", 10, 2)]
    got = {r.event_id: r for r in score_edges(spark.createDataFrame(rows, SCHEMA), cfg).collect()}
    assert (got[2].tick, got[2].score) == (1, 0.0)
    assert got[2].edge_total == 3


@pytest.mark.parametrize("order", ["event_time", "arrival"])
def test_sliced_ticks_give_the_same_scores(spark, monkeypatch, order):
    monkeypatch.setattr(scoring, "SLICE_ROWS", 40)
    cfg = ScorerConfig(tick_seconds=100, alpha=0.5, order=order)
    rows = stream(3, late=0 if order == "event_time" else 60)
    assert_same(score_edges(spark.createDataFrame(rows, SCHEMA), cfg), rows, cfg)


def test_busy_ticks_without_hot_entities_are_not_copied(spark, monkeypatch):
    """Slices are for entities with many events in a tick, not for ticks with many entities."""
    calls = []
    cut = scoring.with_slices
    monkeypatch.setattr(scoring, "with_slices", lambda *a: calls.append(1) or cut(*a))
    monkeypatch.setattr(scoring, "SLICE_ROWS", 12)
    cfg = ScorerConfig(tick_seconds=100, alpha=0.5)
    rows = [(f"c{i % 41}", f"s{i % 37}", 1_000 + i, i) for i in range(600)]
    assert_same(score_edges(spark.createDataFrame(rows, SCHEMA), cfg), rows, cfg)
    assert not calls
    rows += [("c1", f"s{i % 30}", 1_250, 1_000 + i) for i in range(13)]
    assert_same(score_edges(spark.createDataFrame(rows, SCHEMA), cfg), rows, cfg)
    assert calls


@pytest.mark.parametrize("order", ["event_time", "arrival"])
def test_large_batches_carry_their_state(spark, monkeypatch, order):
    monkeypatch.setattr(scoring, "SLICE_ROWS", 50)
    cfg = ScorerConfig(tick_seconds=5, alpha=0.5, order=order)
    rows = sorted(stream(11), key=lambda r: (r[2], r[3]))
    rows = [(s, d, at, i) for i, (s, d, at, _) in enumerate(rows)]
    events = spark.createDataFrame(rows, SCHEMA)
    half = len(rows) // 2
    first, clock = scoring.score_batch(events.filter(events.event_id < half), cfg)
    row = first.folds["edge"][1].agg({"_rank": "max"}).first()
    clock = scoring.Clock(clock.start, clock.max_tick, row[0])
    second, _ = scoring.score_batch(events.filter(events.event_id >= half), cfg, clock, first.counters())
    assert_same(first.scored.unionByName(second.scored), rows, cfg)


def test_slices_cut_a_tick_that_holds_everything(spark, monkeypatch):
    monkeypatch.setattr(scoring, "SLICE_ROWS", 50)
    rows = [("a", "b", 5, i) for i in range(1000)]
    cfg = ScorerConfig(tick_seconds=100)
    events = spark.createDataFrame(rows, SCHEMA)
    profile = scoring.profile_events(events, cfg)
    ticked = scoring.assign_ticks(events, cfg, profile, scoring.Clock(profile.first))
    sliced = scoring.with_slices(ticked, cfg, profile)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == 1000 and len(sizes) >= 15 and max(sizes) <= 100
    first = sliced.groupBy("_slice").agg({"event_id": "min"}).orderBy("_slice").collect()
    assert [r[1] for r in first] == sorted(r[1] for r in first)


def test_partitioning_does_not_matter(spark):
    rows = stream(4)
    events = spark.createDataFrame(rows, SCHEMA)
    cfg = ScorerConfig(tick_seconds=10)
    one = {r.event_id: r.score for r in score_edges(events.repartition(1), cfg).collect()}
    many = {r.event_id: r.score for r in score_edges(events.repartition(13, "dst"), cfg).collect()}
    assert one == many


def test_output_columns_and_passthrough(spark):
    events = spark.createDataFrame([("a", "b", 1, 0, 1, "x")], SCHEMA + ", label smallint, `odd name` string")
    scored = score_edges(events)
    assert scored.columns == [*SCORE_COLUMNS, "event_id", "label", "odd name"]
    row = scored.first()
    assert (row.label, row["odd name"], row.tick, row.score, row.is_alert) == (1, "x", 1, 0.0, False)
    assert len(SCORE_COLUMNS) == 16


def test_burst_scores_higher_than_before(spark):
    rows = []
    for t in range(100):
        rows.append((f"h{t % 20}", f"g{t % 20}", 1_700_000_000 + t, len(rows)))
    rows += [("attacker", "victim", 1_700_000_200, len(rows) + i) for i in range(20)]
    scored = score_edges(spark.createDataFrame(rows, SCHEMA), ScorerConfig())
    burst = scored.filter("src = 'attacker'").orderBy("event_id").collect()
    assert [r.edge_total for r in burst] == list(range(1, 21))
    scores = [r.score for r in burst]
    assert scores == sorted(scores) and scores[-1] > scores[0]
    before = scored.filter("src <> 'attacker'").agg({"score": "max"}).first()[0]
    assert scores[-1] > before


def test_generated_burst_is_caught(spark):
    events = burst_traffic(spark)
    scored = score_edges(events, ScorerConfig(threshold=100.0))
    alerted = scored.filter("is_alert").select("src", "dst").distinct().collect()
    assert ("192.168.1.666", "10.0.0.99") in {tuple(r) for r in alerted}


def test_threshold_zero_flags_everything(spark):
    rows = stream(5, n=50)
    scored = score_edges(spark.createDataFrame(rows, SCHEMA), ScorerConfig(threshold=0.0))
    assert scored.filter("is_alert").count() == 50


def test_chi_squared_cases(spark):
    from edgewatch.functions.scalar import chi_squared

    cases = spark.createDataFrame(
        [(10, 100, 1, 0.0), (10, 0, 5, 0.0), (0, 100, 5, 0.0), (10, 100, 5, 6.25)],
        "a bigint, s bigint, t bigint, want double",
    )
    for row in cases.select("want", chi_squared("a", "s", "t").alias("got")).collect():
        assert math.isclose(row.got, row.want)


@pytest.mark.parametrize(
    "bad",
    [
        {"width": 0}, {"depth": 0}, {"alpha": 1.0}, {"alpha": -0.1}, {"tick_seconds": 0},
        {"threshold": -1.0}, {"counts": "some"}, {"decay": "up"}, {"order": "random"},
        {"hash_fn": "sum"},
    ],
)
def test_bad_parameters(bad):
    with pytest.raises(ValueError):
        ScorerConfig(**bad)


def test_sketch_state_is_bounded(spark):
    cfg = ScorerConfig(counts="sketch", width=16, depth=2, tick_seconds=5)
    rows = [(f"s{i}", f"d{i}", i, i) for i in range(500)]
    result, _ = scoring.score_batch(spark.createDataFrame(rows, SCHEMA), cfg)
    assert result.counters().count() <= 3 * 2 * 16


def test_sketch_places_across_batches_and_chunks(spark, monkeypatch):
    """Chunks end inside groups and groups inside batches."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    cfg = ScorerConfig(tick_seconds=10, alpha=0.6, counts="sketch", width=8, depth=2, hash_fn="md5")
    events = spark.createDataFrame(stream(9), SCHEMA)
    try:
        small = {r.event_id: r for r in score_edges(events, cfg).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {r.event_id: r for r in score_edges(events, cfg).collect()} == small

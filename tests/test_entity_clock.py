"""Counts with a clock per entity against a plain dictionary, over restarts of the stream."""

import json
import os
import random
from types import SimpleNamespace

import pandas as pd
import pytest

from edgewatch.config import ScorerConfig
from edgewatch.sources.streams import file_edges
from edgewatch.streaming.entity_clock import STATE_STORE, EntityClocks, count_with_entity_clocks, deviation, faded

CFG = ScorerConfig(tick_seconds=10, alpha=0.7)


def model(rows, forget):
    state, out = {}, {}
    for src, dst, at, i in rows:
        first, last, current, total = state.get((src, dst), (at, at, 0.0, 0))
        if at > last + forget:
            first, last, current, total = at, at, 0.0, 0
        current = faded(current, at - last, CFG.alpha, CFG.tick_seconds) + 1
        state[(src, dst)] = first, max(last, at), current, total + 1
        ticks = (at - first) // CFG.tick_seconds + 1
        out[i] = (round(current, 9), total + 1, ticks, round(deviation(current, total + 1, ticks), 9))
    return out


def test_counts_over_restarts(spark, tmp_path):
    rnd = random.Random(4)
    rows, now = [], 1_000
    for i in range(90):
        now += rnd.choice([0, 1, 3]) + (500 if i in (30, 60) else 0)
        rows.append((f"a{rnd.randrange(3)}", f"b{rnd.randrange(2)}", now, i))
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    before = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    try:
        for part in range(3):
            name = source / f"{part}.json"
            name.write_text("".join(json.dumps(dict(zip(("src", "dst", "timestamp", "event_id"), r))) + "\n" for r in rows[30 * part : 30 * part + 30]))
            os.utime(name, (1_700_000_000 + part, 1_700_000_000 + part))
            counted = count_with_entity_clocks(file_edges(spark, str(source)), CFG, forget_seconds=100)
            query = counted.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "at"))
            assert query.trigger(availableNow=True).start().awaitTermination(180)
    finally:
        spark.conf.set(STATE_STORE[0], before)
    got = {r.event_id: (round(r.current, 9), r.total, r.age_ticks, round(r.score, 9)) for r in spark.read.parquet(out).collect()}
    assert got == model(rows, 100)


def test_state_by_bucket_and_missing_ids(spark, tmp_path):
    """The store is called for each bucket and not for each edge; a missing id spoils no other."""
    big = 2**60
    rows = [(f"a{i % 300}", None if i % 7 == 0 else f"b{i % 5}", 1_000 + i // 100, big + i) for i in range(900)]
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    before = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    held = []
    try:
        for part in range(2):
            fields = [{k: v for k, v in zip(("src", "dst", "timestamp", "event_id"), r) if v is not None} for r in rows[450 * part : 450 * part + 450]]
            fields += [{"src": "x", "dst": "y", "timestamp": 1_008}] * (1 - part)
            (source / f"{part}.json").write_text("".join(json.dumps(f) + "\n" for f in fields))
            counted = count_with_entity_clocks(file_edges(spark, str(source)), CFG, forget_seconds=100, buckets=8)
            query = counted.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "at"))
            running = query.trigger(availableNow=True).start()
            assert running.awaitTermination(180)
            held += [s["numRowsTotal"] for p in running.recentProgress for s in json.loads(p.json)["stateOperators"]]
    finally:
        spark.conf.set(STATE_STORE[0], before)
    assert 0 < max(held) <= 8
    got = {r.event_id: (round(r.current, 9), r.total, r.age_ticks, round(r.score, 9)) for r in spark.read.parquet(out).collect()}
    assert got.pop(None) == (1.0, 1, 1, 0.0) and got == model(rows, 100)


def test_timer_forgets_edges_of_a_bucket():
    class Store:
        value, timers = None, set()

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

    store = Store()
    handle = SimpleNamespace(getValueState=lambda *a: store, registerTimer=store.timers.add, deleteTimer=store.timers.remove)
    clocks = EntityClocks(CFG.alpha, CFG.tick_seconds, 100)
    clocks.init(handle)

    def at(seconds):
        return SimpleNamespace(getCurrentWatermarkInMs=lambda: seconds * 1000)

    part = pd.DataFrame({"src": ["a", "b", "a"], "dst": ["c"] * 3, "timestamp": [1_000, 1_040, 1_010], "event_id": [1, 2, 3], "has_id": True})
    (out,) = clocks.handleInputRows((0,), iter([part]), at(0))
    assert out["event_id"].tolist() == [1, 3, 2] and out["total"].tolist() == [1, 2, 1] and store.timers == {1_110_000}
    clocks.handleExpiredTimer((0,), at(1_110), None)
    store.timers.discard(1_110_000)  # by Spark, after the call
    assert store.value[:4] == (["b"], ["c"], [1_040], [1_040]) and store.timers == {1_140_000}
    clocks.handleExpiredTimer((0,), at(1_200), None)
    assert store.value is None


def test_fading():
    assert faded(8.0, 10, 0.5, 10) == 4.0 and faded(8.0, 0, 0.5, 10) == 8.0 and faded(8.0, -5, 0.5, 10) == 8.0
    assert deviation(5.0, 5, 1) == 0.0 and deviation(10.0, 100, 5) == pytest.approx(6.25)

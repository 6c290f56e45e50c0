import json
import random
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from edgewatch.operators import alerts, evaluate, monitor, replay
from traffic import burst_traffic, steady_traffic

ALERT = "src string, dst string, timestamp bigint, event_id bigint, score double, is_alert boolean"


def alert_list(n=300, seed=0):
    rng = random.Random(seed)
    rows, now = [], 1_700_000_000
    for i in range(n):
        now += rng.choice([0, 1, 1, 3])
        rows.append((f"a{rng.randint(0, 15)}", f"b{rng.randint(0, 9)}", now, i, rng.random() * 9, rng.random() < 0.8))
    return rows


@pytest.fixture(scope="module")
def raised(spark):
    return alerts.alert_rows(spark.createDataFrame(alert_list(), ALERT)).cache()


def shown(limit_nodes, limit_edges):
    """What a display that is fed alert by alert ends up with."""
    edges, nodes = {}, {}
    for src, dst, _, _, score, is_alert in alert_list():
        if is_alert:
            nodes.setdefault(src, None)
            nodes.setdefault(dst, None)
            edges[(src, dst)] = score
    return list(nodes)[-limit_nodes:], dict(list(edges.items())[-limit_edges:])


@pytest.mark.parametrize("limit_nodes,limit_edges", [(8, 20), (1000, 1000)])
def test_alert_graph(raised, limit_nodes, limit_edges):
    nodes, edges = shown(limit_nodes, limit_edges)
    got = {(r.source, r.target): r.score for r in monitor.alert_graph_edges(raised, limit_edges).collect()}
    assert got == edges
    rows = monitor.alert_graph_nodes(raised, limit_nodes, limit_edges).collect()
    assert {r.node for r in rows} == set(nodes)
    for r in rows:
        out, into = sum(s == r.node for s, _ in edges), sum(d == r.node for _, d in edges)
        assert (r.out_degree, r.in_degree, r.degree) == (out, into, out + into)
        role = "source" if out > into + 1 else "sink" if into > out + 1 else "balanced"
        assert (r.role, r.alerted) == (role, out + into > 0)


@pytest.mark.parametrize("seconds", [1, 3])
def test_alert_rate(raised, seconds):
    times = [r[2] for r in alert_list() if r[5]]
    got = {r.second: r.alerts for r in monitor.alert_rate(raised, seconds).collect()}
    assert got == {t: sum(t - seconds <= u <= t for u in times) for t in set(times)}


def test_feed(raised):
    newest = [r[3] for r in alert_list() if r[5]][::-1][:12]
    assert [r.event_id for r in monitor.alert_feed(raised).collect()] == newest
    assert [r.event_id for r in alerts.alerts_in_order(raised).collect()][-12:] == newest[::-1]


def test_messages(raised):
    row = alerts.alert_messages(raised).first()
    body = json.loads(row.value)
    assert body["type"] == "alert" and body["data"]["alert_id"] == row.alert_id
    assert len(row.alert_id) == 36 and row.alert_id.count("-") == 4
    assert body["data"]["subgraph_nodes"] == [body["data"]["src"], body["data"]["dst"]]
    ids = [r.alert_id for r in raised.select("alert_id").collect()]
    assert len(set(ids)) == len(ids)


def test_score_stats(spark):
    rows = [*alert_list(), ("test_src", "x", 5, 10_000, 99.0, True)]
    ingested = F.timestamp_seconds(F.col("timestamp") + F.col("event_id") % 5)
    scores = alerts.score_rows(spark.createDataFrame(rows, ALERT), ingested)
    row = evaluate.score_stats(scores).first()
    delays = [r[3] % 5 for r in alert_list() if r[5]]
    assert (row.total_events, row.total_alerts) == (300, len(delays))
    assert (row.max_detection_delay, row.avg_detection_delay) == (4.0, pytest.approx(sum(delays) / len(delays)))
    assert row.max_score == max(r[4] for r in alert_list())


def test_timeline(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_idx")
    got = replay.replay_timeline(df, 300, 50, limit=700).groupBy("timestamp").count().collect()
    assert {r.timestamp: r["count"] for r in got} == {50: 300, 51: 300, 52: 100}
    assert replay.replay_timeline(df, 300, 50, limit=0).count() == 0
    with pytest.raises(ValueError):
        replay.replay_timeline(df, 0, 50)


def test_flow_events(spark):
    flows = spark.createDataFrame(
        [
            (0, "1.1.1.1", None, datetime(2017, 7, 3, 8, tzinfo=timezone.utc), "DDoS", True, "DDoS", "id0", "7", 1.5, "tcp"),
            (1, "1.1.1.1", "2.2.2.2", datetime(2017, 7, 3, 9, tzinfo=timezone.utc), "Benign", False, "Benign", "id1", "x", None, "udp"),
        ],
        "row_idx long, `Source IP` string, `Destination IP` string, Timestamp timestamp, Label string,"
        " is_attack boolean, attack_type string, `Flow ID` string, `Flow Bytes/s` string, `Idle Max` double, Protocol string",
    )
    first, second = replay.replay_events(flows, rate=1, start=100).orderBy("row_idx").collect()
    assert (first.src, first.dst, first.timestamp, first.label, first.attack_type) == ("1.1.1.1", "0.0.0.0", 100, 1, "DDoS")
    assert first.features == {"Flow Bytes/s": 7.0, "Idle Max": 1.5}
    assert (second.timestamp, second.label, second.features) == (101, 0, {})
    kept = replay.replay_events(flows, preserve_timestamps=True).orderBy("row_idx").first()
    assert kept.timestamp == 1499068800
    body = json.loads(replay.replay_json(flows, rate=1, start=100).orderBy("row_idx").first().value)
    assert body == {
        "src": "1.1.1.1", "dst": "0.0.0.0", "timestamp": 100, "label": 1, "attack_type": "DDoS",
        "Flow Bytes/s": 7.0, "Idle Max": 1.5,
    }


def test_edge_json(spark):
    df = spark.createDataFrame([(0, "a", "b", 5, None), (1, "a", "b", 6, 1)], "row_idx long, src string, dst string, timestamp long, label int")
    bodies = [json.loads(r.value) for r in replay.edges_json(df).orderBy("row_idx").collect()]
    assert bodies == [{"src": "a", "dst": "b", "timestamp": 5}, {"src": "a", "dst": "b", "timestamp": 6, "label": 1}]


def test_generated_traffic(spark):
    df = burst_traffic(spark)
    assert df.count() == 540
    assert df.select("event_id").distinct().count() == 540
    attack = df.filter("label = 1").agg(F.count("*"), F.min("timestamp"), F.max("timestamp")).first()
    assert attack[0] == 40 and attack[2] - attack[1] <= 5
    assert {tuple(r) for r in df.collect()} == {tuple(r) for r in burst_traffic(spark).collect()}
    steady = steady_traffic(spark, events=10_000, burst_start=5_000, burst_length=100)
    assert steady.filter("src = '192.168.1.255' AND dst = '10.0.0.255'").count() == 100
    assert steady.groupBy("timestamp").count().filter("count = 100").count() == 100


def test_live_replay_keeps_pace_and_order(spark, tmp_path):
    rows = spark.range(120).select(F.col("id").alias("row_idx"), (F.col("id") * 7).alias("payload"))
    out, began = [], time.monotonic()

    def send(due, batch_id):
        out.append((time.monotonic() - began, sorted(tuple(r) for r in due.collect())))

    query = replay.replay_live(rows, 40, send, str(tmp_path / "at"))
    try:
        while sum(len(rows) for _, rows in out) < 120 and time.monotonic() - began < 60:
            time.sleep(0.2)
    finally:
        query.stop()
    sent = [r for _, rows in out for r in rows]
    assert sent == [(i, 7 * i) for i in range(120)]
    assert all(at >= max(r[0] for r in rows) // 40 for at, rows in out if rows)  # none before its second
    with pytest.raises(ValueError):
        replay.replay_live(rows, 0, send, str(tmp_path / "at"))

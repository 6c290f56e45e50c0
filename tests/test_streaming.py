import json
import os

import pytest

from edgewatch.config import ScorerConfig
from edgewatch.sources.streams import EVENT_SCHEMA, decode_events, file_edges
from edgewatch.sources.tables import read_alerts, read_scores
from edgewatch.operators.monitor import alert_rate
from edgewatch.operators.scoring import Clock
from edgewatch.streaming.job import ScoringJob, scoring_job
from edgewatch.streaming.rates import RateTable
from edgewatch.streaming.state import StateStore, touched_buckets
from model import score_all
from test_scoring import SCHEMA, stream

CONFIGS = {
    "exact": ScorerConfig(tick_seconds=10, alpha=0.6, threshold=3.0),
    "sketch": ScorerConfig(
        tick_seconds=10, alpha=0.6, threshold=3.0, counts="sketch", width=6, depth=2, hash_fn="md5"
    ),
    "late": ScorerConfig(tick_seconds=10, alpha=0.6, threshold=3.0, order="arrival"),
    "filtered": ScorerConfig(
        tick_seconds=10, alpha=0.6, threshold=3.0, filter_anomalies=True, filter_cutoff=2.0
    ),
}


def run_batches(spark, job, rows, cuts):
    for i, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        job.process(spark.createDataFrame(rows[low:high], SCHEMA), i)


@pytest.mark.parametrize("name", CONFIGS)
def test_micro_batches_equal_one_stream(spark, tmp_path, name):
    cfg = CONFIGS[name]
    rows = stream(7, n=300, late=60 if name == "late" else 0)
    if name != "late":
        rows.sort(key=lambda r: (r[2], r[3]))
    job = ScoringJob(str(tmp_path), cfg, compact_every=2)
    run_batches(spark, job, rows, [1, 120, 200])
    expected = score_all(rows, cfg)
    scores = read_scores(spark, f"{tmp_path}/scores").collect()
    assert len(scores) == len(rows)
    for r in scores:
        assert r.anomaly_score == pytest.approx(expected[r.id]["score"], rel=1e-12), r.id
    flagged = {i for i, e in expected.items() if e["score"] >= cfg.threshold}
    alerts = read_alerts(spark, f"{tmp_path}/alerts").collect()
    assert {r.event_id for r in alerts} == flagged and len(alerts) == len(flagged)


def test_running_a_batch_again_changes_nothing(spark, tmp_path):
    cfg = CONFIGS["exact"]
    rows = sorted(stream(8, n=200), key=lambda r: (r[2], r[3]))
    parts = [rows[:80], rows[80:]]
    job = ScoringJob(str(tmp_path), cfg)
    for i in (0, 1, 1):
        job.process(spark.createDataFrame(parts[i], SCHEMA), i)
    expected = score_all(rows, cfg)
    scores = read_scores(spark, f"{tmp_path}/scores").collect()
    assert sorted(r.id for r in scores) == sorted(expected)
    assert all(r.anomaly_score == pytest.approx(expected[r.id]["score"]) for r in scores)
    ids = [r.alert_id for r in read_alerts(spark, f"{tmp_path}/alerts").collect()]
    assert len(ids) == len(set(ids))


def test_empty_batch_is_skipped(spark, tmp_path):
    job = ScoringJob(str(tmp_path), CONFIGS["exact"])
    rows = [("a", "b", 100 + i, i) for i in range(40)]
    job.process(spark.createDataFrame(rows[:20], SCHEMA), 0)
    job.process(spark.createDataFrame([], SCHEMA), 1)
    job.process(spark.createDataFrame(rows[20:], SCHEMA), 2)
    assert read_scores(spark, f"{tmp_path}/scores").count() == 40


def test_file_stream_end_to_end(spark, tmp_path):
    rows = sorted(stream(9, n=120), key=lambda r: (r[2], r[3]))
    source = tmp_path / "in"
    source.mkdir()
    for part in range(3):
        with open(source / f"{part}.json", "w") as f:
            for src, dst, ts, i in rows[part * 40 : part * 40 + 40]:
                f.write(json.dumps({"src": src, "dst": dst, "timestamp": ts, "event_id": i, "label": 1}) + "\n")
        # the file source takes files by age, so files of the same millisecond have no order
        os.utime(source / f"{part}.json", (1_700_000_000 + part, 1_700_000_000 + part))
    sent = []
    job = ScoringJob(
        str(tmp_path / "out"), CONFIGS["exact"], publish=lambda df, i: sent.extend(df.collect())
    )
    query = job.start(file_edges(spark, str(source), files_per_batch=1), availableNow=True)
    assert query.awaitTermination(300)
    expected = score_all(rows, CONFIGS["exact"])
    scores = read_scores(spark, f"{tmp_path}/out/scores").collect()
    assert {r.id: round(r.anomaly_score, 9) for r in scores} == {
        i: round(e["score"], 9) for i, e in expected.items()
    }
    assert {r.label for r in scores} == {1}
    flagged = [i for i, e in expected.items() if e["score"] >= 3.0]
    assert len(sent) == len(flagged)
    if sent:
        message = json.loads(sent[0].value)
        assert message["type"] == "alert"
        assert set(message["data"]) == {"alert_id", "src", "dst", "timestamp", "score", "subgraph_nodes"}


def test_messages_are_written_as_files(spark):
    cfg = ScorerConfig(threshold=0.0)
    job = scoring_job(spark, "job-messages", cfg)
    job.process(spark.createDataFrame([("a", "b", 1, 0)], SCHEMA), 0)
    lines = spark.read.text(f"{job.path}/messages").collect()
    assert json.loads(lines[0].value)["data"]["subgraph_nodes"] == ["a", "b"]


def test_decoding_json(spark):
    raw = spark.createDataFrame([('{"src":"a","dst":"b","timestamp":5}',)], "value string")
    row = decode_events(raw).select("e.*").first()
    assert tuple(row) == ("a", "b", 5, None)
    assert EVENT_SCHEMA.fieldNames() == ["src", "dst", "timestamp", "label", "event_id"]


def test_state_folders_do_not_pile_up(spark, tmp_path):
    cfg = CONFIGS["exact"]
    rows = sorted(stream(11, n=120), key=lambda r: (r[2], r[3]))
    job = ScoringJob(str(tmp_path), cfg, compact_every=3)
    seen = []
    for batch in range(10):
        part = spark.createDataFrame(rows[12 * batch : 12 * (batch + 1)], SCHEMA)
        job.process(part, batch)
        folders = {k: os.listdir(tmp_path / "state" / k) for k in ("clock", "delta", "base") if (tmp_path / "state" / k).exists()}
        seen.append({k: len([f for f in v if f.startswith("batch=")]) for k, v in folders.items()})
    assert max(s["clock"] for s in seen) <= 2
    assert max(s["delta"] for s in seen) <= 4 and max(s.get("base", 0) for s in seen) <= 5
    job.process(part, batch)  # the last batch again
    expected = score_all(rows, cfg)
    scores = read_scores(spark, f"{tmp_path}/scores").collect()
    assert {r.id: round(r.anomaly_score, 9) for r in scores} == {i: round(e["score"], 9) for i, e in expected.items()}


def sized(path):
    return sum(os.path.getsize(f.removeprefix("file://")) for f in path.inputFiles())


def counters(spark, ids):
    rows = [(kind, f"{kind}{i}", None, None, 1, float(i), i) for i in ids for kind in ("src", "dst")]
    return spark.createDataFrame(
        rows, "kind string, key1 string, key2 string, cell bigint, rank bigint, current double, total bigint"
    )


def test_a_batch_reads_and_rewrites_only_its_buckets(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), compact_every=2, buckets=64)
    for batch, ids in enumerate((range(2000), range(2000, 4000), range(5), range(3))):
        store.save(batch, counters(spark, ids), Clock(0, batch, 1))
    few = spark.createDataFrame([("src1", "dst1")], "src string, dst string")
    touched = touched_buckets(few, 64)
    assert 1 <= len(touched) <= 3
    _, everything = store.load(4)
    _, own = store.load(4, touched)
    assert sized(own) < sized(everything) / 8
    # the second compaction wrote the buckets of a few entities, not the whole base
    folders = [f for f in os.listdir(tmp_path / "base" / "batch=3") if f.startswith("bucket=")]
    assert len(folders) <= 10 < len([f for f in os.listdir(tmp_path / "base" / "batch=1") if f.startswith("bucket=")])
    assert store.counters(4).count() == 8000
    assert own.filter("kind = 'src' AND key1 = 'src1'").count() == 1  # all of it is in the base


def test_running_a_compaction_again_leaves_the_same_counters(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), compact_every=2, buckets=8)
    for batch in (0, 1, 1, 2, 3, 3):
        store.clean_up(batch)
        store.save(batch, counters(spark, range(batch, batch + 10)), Clock(0, batch, 1))
    rows = {(r.kind, r.key1): r.total for r in store.counters(4).collect()}
    assert rows == {(k, f"{k}{i}"): i for k in ("src", "dst") for i in range(13)}


def test_many_batches_read_no_more_than_few(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), compact_every=4, buckets=16)
    touched = touched_buckets(spark.createDataFrame([("src1", "dst1")], "src string, dst string"), 16)
    files = []
    for batch in range(12):
        store.clean_up(batch)
        store.save(batch, counters(spark, [1, 2, 3]), Clock(0, batch, 1))
        files.append(len(store.load(batch + 1, touched)[1].inputFiles()))
    assert max(files[8:]) <= max(files[4:8])


@pytest.mark.parametrize("policy", ["score", "drop", "divert"])
def test_events_beyond_the_watermark(spark, tmp_path, policy):
    cfg = ScorerConfig(tick_seconds=10, alpha=0.6, threshold=3.0, order="arrival")
    rows = [(f"a{i % 5}", "b", 1000 + i - (200 if i % 9 == 8 else 0), i) for i in range(120)]
    job = ScoringJob(str(tmp_path), cfg, delay_seconds=50, late=policy)
    run_batches(spark, job, rows, [40, 80])
    job.process(spark.createDataFrame(rows[80:], SCHEMA), 2)  # again
    mark = {0: None, 1: max(r[2] for r in rows[:40]) - 50, 2: max(r[2] for r in rows[:80]) - 50}
    late = {r[3] for r in rows if mark[r[3] // 40] is not None and r[2] < mark[r[3] // 40]}
    assert len(late) > 5
    kept = rows if policy == "score" else [r for r in rows if r[3] not in late]
    expected = score_all(kept, cfg)
    scores = read_scores(spark, f"{tmp_path}/scores").collect()
    assert {r.id: round(r.anomaly_score, 9) for r in scores} == {i: round(e["score"], 9) for i, e in expected.items()}
    assert (tmp_path / "late").exists() == (policy == "divert")
    if policy == "divert":
        assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/late").collect()) == sorted(late)


def test_late_policy_is_validated(tmp_path):
    with pytest.raises(ValueError):
        ScoringJob(str(tmp_path), late="never")
    with pytest.raises(ValueError):
        ScoringJob(str(tmp_path), delay_seconds=-1)


def test_sliding_rate_of_a_stream_equals_the_batch_rate(spark, tmp_path):
    stamps = [100, 100, 101, 103, 104, 104, 110, 111, 111, 112, 120]
    source = tmp_path / "in"
    rates = RateTable(str(tmp_path / "rates"))
    for part in range(3):
        rows = [(t,) for t in stamps[part * 4 : part * 4 + 4]]
        events = spark.createDataFrame(rows, "t bigint").selectExpr("timestamp_seconds(t) AS event_time")
        events.write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("event_time timestamp").parquet(str(source))
        assert rates.start(stream, seconds=2, availableNow=True).awaitTermination(120)
    every = spark.createDataFrame([(t,) for t in stamps], "t bigint").selectExpr("timestamp_seconds(t) AS event_time")
    wanted = {r.second: r.alerts for r in alert_rate(every, 2).collect()}
    assert {r.second: r.alerts for r in rates.read(spark).collect()} == wanted

import random

import pytest
from pyspark.sql import functions as F

from edgewatch.config import ScorerConfig
from edgewatch.operators.alerts import alert_rows, score_rows
from edgewatch.operators.scoring import score_edges
from edgewatch.plans.detection import compare_detectors
from edgewatch.plans.flow_analysis import analyze_flows, ingest_flows
from edgewatch.session import SHUFFLE_CLEANUP, materialize, shared_dir
from edgewatch.sinks.messages import write_message_files
from edgewatch.sinks.tables import flat_columns, write_table
from edgewatch.sources.tables import read_scores
from traffic import burst_traffic


def write_flows(folder, n=400):
    rng = random.Random(0)
    lines = ["Flow ID, Source IP, Destination IP, Timestamp, Flow Duration, SYN Flag Count, Flow Bytes/s, Label"]
    for i in range(n):
        label, syn = ("Port Scan", rng.randint(20, 60)) if i % 4 == 0 else ("BENIGN", rng.randint(0, 5))
        rate = "Infinity" if i % 50 == 7 else str(rng.random() * 100)
        lines.append(f"{i},1.1.1.{i % 9},2.2.2.2,3/7/2017 8:{i % 60}:00 AM,{rng.randint(1, 999)},{syn},{rate},{label}")
    lines.append(lines[1])
    (folder / "day.csv").write_text("\n".join(lines) + "\n")


def test_files_to_report(spark, tmp_path):
    write_flows(tmp_path)
    out = str(tmp_path / "clean")
    summary = ingest_flows(spark, out, str(tmp_path / "*.csv")).first()
    assert (summary.total_rows, summary.benign_rows, summary.attack_rows, summary.files_loaded) == (400, 300, 100, 1)
    cleaned = spark.read.parquet(out)
    assert cleaned.filter("isnan(`Flow Bytes/s`) OR `Flow Bytes/s` IS NULL").count() == 0
    assert cleaned.filter("Timestamp IS NULL").count() == 0
    analysis = analyze_flows(cleaned)
    text = analysis.write(str(tmp_path / "report"))
    assert "## PortScan" in text and "SYN Flag Count" in text
    for name in ("attribute_table", "feature_statistics", "feature_importance", "feature_correlation"):
        assert spark.read.option("header", True).csv(f"{tmp_path}/report/{name}").count() >= 1
    row = analysis.table.first()
    assert row.attack_type == "PortScan" and row.rule_precision == 1.0 and row.rule_recall == 1.0


def test_detectors_side_by_side(spark):
    rows = {
        r.method: r
        for r in compare_detectors(burst_traffic(spark), ScorerConfig(threshold=50.0)).collect()
    }
    assert set(rows) == {"batch", "streaming"}
    assert rows["batch"].recall == rows["streaming"].recall == 1.0
    assert rows["batch"].max_detection_delay is None
    assert rows["streaming"].flagged_events >= rows["streaming"].flagged_edges


def test_tables_round_trip(spark, tmp_path):
    scored = score_edges(burst_traffic(spark), ScorerConfig(threshold=50.0))
    path = f"{tmp_path}/scores"
    write_table(score_rows(scored), path, 0)
    write_table(score_rows(scored), path, 0)
    back = read_scores(spark, path)
    assert back.count() == 540
    assert back.select("event_date").distinct().count() == 1
    alerts = alert_rows(scored)
    write_message_files(alerts.selectExpr("alert_id AS value"), f"{tmp_path}/m", 3)
    assert spark.read.text(f"{tmp_path}/m/batch_id=3").count() == alerts.count()


def test_shuffles_of_a_written_frame_can_be_dropped(spark):
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = set(shuffles.keySet().mkString(",").split(","))
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert materialize(counted, "t", drop_shuffles=True).count() == 7
    left = set(shuffles.keySet().mkString(",").split(",")) - before
    # the count of the written rows has one of its own
    assert len(left) <= 1
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_materialized_frames_live_in_the_shared_folder(spark):
    df = materialize(spark.range(10), "t")
    assert df.count() == 10
    assert all(f.startswith(shared_dir(spark)) for f in df.inputFiles())


def test_columns_for_databases_are_flat(spark):
    rows = spark.createDataFrame([(["a", "b"], 1)], "nodes array<string>, n int")
    assert [tuple(r) for r in flat_columns(rows).collect()] == [('["a","b"]', 1)]
    assert flat_columns(rows.select("n")).columns == ["n"]

"""Compacted tables hold the same rows, and a day's rows lie in one folder."""

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from edgewatch.sinks.compaction import compact_table, manifest, read_table
from edgewatch.sinks.tables import write_table
from edgewatch.sources.tables import read_alerts, read_scores
from edgewatch.operators.alerts import alert_rows

DAY = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)


def put(spark, path, batch, days):
    rows = [(f"{batch}-{d}-{i}", DAY + timedelta(days=d)) for d in days for i in range(3)]
    write_table(spark.createDataFrame(rows, "name string, event_time timestamp"), path, batch)


def names(frame):
    return sorted((r["name"], str(r["event_date"]), r["batch_id"]) for r in frame.collect())


def test_rows_stay_the_same(spark, tmp_path):
    path = str(tmp_path)
    assert read_table(spark, path) is None
    for batch, days in enumerate(([0, 1], [1, 2], [2], [0, 5])):
        put(spark, path, batch, days)
    before = names(read_table(spark, path))
    for upto in (1, 1, 2, 3):
        compact_table(spark, path, upto)
        assert names(read_table(spark, path)) == before
    put(spark, path, 4, [5])
    assert len(names(read_table(spark, path))) == len(before) + 3


def test_a_day_reads_its_own_folder(spark, tmp_path):
    path = str(tmp_path)
    for batch in range(6):
        put(spark, path, batch, range(4))
    day = date(2024, 5, 3)
    many = read_table(spark, path, day, day).inputFiles()
    compact_table(spark, path, 5)
    own = read_table(spark, path, day, day)
    assert {f.rpartition("/")[0].rpartition("/")[2] for f in own.inputFiles()} == {f"event_date={day}"}
    assert len(own.inputFiles()) < len(many)
    assert own.count() == 18 and own.select("event_date").distinct().count() == 1


def test_days_without_new_rows_are_not_written_again(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, 0, [0, 1])
    compact_table(spark, path, 0)
    put(spark, path, 1, [1])
    compact_table(spark, path, 1)
    _, upto, days = manifest(spark, path)
    assert upto == 1 and days == {date(2024, 5, 1): 0, date(2024, 5, 2): 1}
    # the first batch is still there for readers of the manifest before; the next compaction takes it away
    put(spark, path, 2, [1])
    compact_table(spark, path, 2)
    assert not (tmp_path / "batch_id=0").exists() and (tmp_path / "batch_id=2").exists()


def test_a_failed_compaction_changes_nothing(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, 0, [0])
    rows = names(read_table(spark, path))
    spark.createDataFrame([("x", 7)], "name string, batch_id int").write.parquet(f"{path}/_days/version=0/event_date=2024-05-01")
    assert names(read_table(spark, path)) == rows
    compact_table(spark, path, 0)
    assert names(read_table(spark, path)) == rows


def test_alerts_and_scores_are_read_through_it(spark, tmp_path):
    scored = spark.createDataFrame([("a", "b", 1_700_000_000, 5, 9.0, True)], "src string, dst string, timestamp bigint, event_id bigint, score double, is_alert boolean")
    write_table(alert_rows(scored), str(tmp_path), 0)
    before = read_alerts(spark, str(tmp_path)).drop("created_at").collect()
    compact_table(spark, str(tmp_path), 0)
    assert read_alerts(spark, str(tmp_path)).drop("created_at").collect() == before
    assert read_scores.__doc__ and F is not None

"""The message log: order and offsets, whole epochs, restarts."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edgewatch.sources import edge_log
from edgewatch.sources.edge_log import LogFolder, append_log, follow_log, log_rows, read_log, stream_log
from edgewatch.sources.streams import topic_events


def messages(spark, ids):
    rows = [(f"m{i}", i % 3, 1_700_000_000 + i) for i in ids]
    df = spark.createDataFrame(rows, "value string, p int, at long").coalesce(1)
    return log_rows(df, F.col("p"), F.timestamp_seconds("at"))


def stored(spark, path):
    rows = read_log(spark, path).orderBy("partition", "offset").collect()
    return [(r["partition"], r["offset"], r["value"]) for r in rows]


def test_offsets_count_on_in_every_partition(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(spark, messages(spark, range(7)), path)
    append_log(spark, messages(spark, range(7, 10)), path)
    expected = [(p, k, f"m{i}") for p in range(3) for k, i in enumerate(x for x in range(10) if x % 3 == p)]
    assert stored(spark, path) == expected
    assert read_log(spark, path).agg(F.max(F.unix_seconds("timestamp"))).first()[0] == 1_700_000_009


def test_segments_without_a_commit_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(spark, messages(spark, range(3)), path)
    batch = pa.RecordBatch.from_pylist(
        [{"partition": 0, "offset": None, "timestamp": None, "value": "lost"}], schema=edge_log.SCHEMA
    )
    written = LogFolder(path).write_segments(iter([batch]))
    assert len(stored(spark, path)) == 3
    LogFolder(path).remove([written, None])
    assert len(os.listdir(tmp_path / "log" / "segments")) == 3


def test_a_batch_that_is_committed_again_adds_nothing(tmp_path):
    log = LogFolder(str(tmp_path / "log"))
    segment = edge_log.Segment("x.parquet", 1, 5)
    for batch in (0, 1, 1, 0, 2):
        log.append([segment], "s", batch)
    assert log.last() == 3
    assert [s.base for s in log.segments(0, 3)] == [0, 5, 10]
    log.append([segment], "other", 0)
    assert log.segments(3, 4)[0].base == 15


def test_pointer_may_be_behind(tmp_path):
    log = LogFolder(str(tmp_path / "log"))
    for batch in range(4):
        log.append([edge_log.Segment("x.parquet", 0, 1)], "s", batch)
    (tmp_path / "log" / "last").write_text("1")
    assert LogFolder(str(tmp_path / "log")).last() == 4


def test_reader_goes_on_where_it_stopped(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")

    def follow():
        query = follow_log(spark, path).writeStream.format("parquet").option("path", out)
        query = query.option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)

    for ids in (range(5), range(5, 6), range(6, 20)):
        append_log(spark, messages(spark, ids), path)
        follow()
    follow()
    values = sorted(r["value"] for r in spark.read.parquet(out).collect())
    assert values == sorted(f"m{i}" for i in range(20))


def test_writing_stream_restarts_without_loss_or_repeats(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "log")
    source.mkdir()

    def run():
        lines = spark.readStream.schema("value string, at long").option("maxFilesPerTrigger", 1).json(str(source))
        rows = log_rows(lines, F.lit(0), F.timestamp_seconds("at"))
        assert stream_log(rows, path, "s", str(tmp_path / "at"), availableNow=True).awaitTermination(120)

    for part in range(3):
        for k in range(2):
            name = source / f"{part}-{k}.json"
            name.write_text("".join(json.dumps({"value": f"{part}-{k}-{i}", "at": i}) + "\n" for i in range(4)))
        run()
    # the last batch as if its commit had not been noted by the query
    newest = max(int(n) for n in os.listdir(tmp_path / "at" / "commits") if n.isdigit())
    (tmp_path / "at" / "commits" / str(newest)).unlink()
    (tmp_path / "at" / "commits" / f".{newest}.crc").unlink(missing_ok=True)
    run()
    values = [v for _, _, v in stored(spark, path)]
    assert sorted(values) == sorted(f"{p}-{k}-{i}" for p in range(3) for k in range(2) for i in range(4))
    assert [o for _, o, _ in stored(spark, path)] == list(range(24))


def test_topic_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    value = '{"src":"a","dst":"b","timestamp":5}'
    df = spark.createDataFrame([(value, 7)], "value string, at long")
    append_log(spark, log_rows(df, F.lit(None), F.timestamp_seconds("at")), path)
    row = topic_events(read_log(spark, path)).first()
    assert (row["src"], row["timestamp"], row["event_id"], row["arrival"]["at"]) == ("a", 5, 0, 7_000_000)


def test_a_log_is_never_overwritten(spark, tmp_path):
    append_log(spark, messages(spark, range(2)), str(tmp_path / "log"))
    with pytest.raises(Exception, match="only be appended"):
        messages(spark, range(2)).write.format(edge_log.FORMAT).mode("overwrite").save(str(tmp_path / "log"))

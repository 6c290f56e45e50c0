"""A partitioned, append-only log of messages in a shared folder, as a source and sink of Spark.

``spark.dataSource.register(EdgeLog)`` makes ``format("edge_log")`` known, for ``read``, ``write``,
``readStream`` and ``writeStream``. It has the columns of a topic: ``partition, offset, timestamp, value``.

Each task writes a Parquet segment per partition. A commit is one small file with a running number; it
lists segments with their first offsets and is moved into place when the epoch is complete, so readers see
whole epochs only. A stream's commit also names the stream and its batch: a batch that is written again
after a failure finds its number there and adds nothing. A position in the log is the number of a commit.
One writer at a time may append to a log.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

FORMAT = "edge_log"
COLUMNS = "partition int, offset long, timestamp timestamp, value string"
SCHEMA = pa.schema(
    [("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", tz="UTC")), ("value", pa.string())]
)
STORED = ["timestamp", "value"]


@dataclass
class Segment(InputPartition):
    """Rows of one partition that were written by one task, from offset ``base`` on."""

    file: str
    partition: int
    rows: int
    base: int = 0


@dataclass
class Written(WriterCommitMessage):
    segments: list[Segment]


class LogFolder:
    """Commits and segments below a path of any file system that Arrow knows."""

    def __init__(self, path: str):
        self.fs, self.root = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/commits/{number:020d}.json"

    def _exists(self, path: str) -> bool:
        return self.fs.get_file_info(path).type == pafs.FileType.File

    def _read(self, path: str) -> bytes:
        with self.fs.open_input_stream(path) as f:
            return f.read()

    def last(self) -> int:
        """Number of the last commit, 0 if there is none."""
        pointer = f"{self.root}/last"
        number = int(self._read(pointer)) if self._exists(pointer) else 0
        while self._exists(self._commit_path(number + 1)):  # the pointer may be behind
            number += 1
        return number

    def commit_at(self, number: int) -> dict:
        if number == 0:
            return {"next": {}, "batches": {}, "segments": []}
        return json.loads(self._read(self._commit_path(number)))

    def segments(self, start: int, end: int) -> list[Segment]:
        """The segments of the commits after ``start``, up to ``end``."""
        return [Segment(**s) for number in range(start + 1, end + 1) for s in self.commit_at(number)["segments"]]

    def append(self, segments: list[Segment], stream: str | None = None, batch: int | None = None) -> None:
        """Commit segments, unless this batch of the stream has been committed before."""
        number = self.last()
        state = self.commit_at(number)
        if stream is not None and state["batches"].get(stream, -1) >= batch:
            return
        offsets, listed = dict(state["next"]), []
        for s in segments:
            base = offsets.get(str(s.partition), 0)
            listed.append({"file": s.file, "partition": s.partition, "rows": s.rows, "base": base})
            offsets[str(s.partition)] = base + s.rows
        batches = state["batches"] | ({stream: batch} if stream is not None else {})
        self._put(self._commit_path(number + 1), json.dumps({"next": offsets, "batches": batches, "segments": listed}))
        self._put(f"{self.root}/last", str(number + 1))

    def _put(self, path: str, text: str) -> None:
        """Write a whole file by moving it into its place."""
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        hidden = f"{self.root}/.new-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(hidden) as f:
            f.write(text.encode())
        self.fs.move(hidden, path)

    def write_segments(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """Store the rows of a task; they belong to the log once they are committed."""
        files: dict[int, tuple[str, pq.ParquetWriter]] = {}
        rows: dict[int, int] = {}
        schema = pa.schema([SCHEMA.field(c) for c in STORED])
        try:
            for batch in batches:
                own = pa.Table.from_batches([batch])
                numbers = own["partition"].to_numpy()
                for p in np.unique(numbers).tolist():
                    part = own.filter(pa.array(numbers == p)).select(STORED).cast(schema)
                    if p not in files:
                        name = f"{uuid.uuid4().hex}.parquet"
                        self.fs.create_dir(f"{self.root}/segments", recursive=True)
                        files[p] = name, pq.ParquetWriter(f"{self.root}/segments/{name}", schema, filesystem=self.fs)
                    files[p][1].write_table(part)
                    rows[p] = rows.get(p, 0) + part.num_rows
        finally:
            for _, writer in files.values():
                writer.close()
        return Written([Segment(name, p, rows[p]) for p, (name, _) in sorted(files.items())])

    def rows_of(self, segment: Segment) -> Iterator[pa.RecordBatch]:
        place = segment.base
        with pq.ParquetFile(f"{self.root}/segments/{segment.file}", filesystem=self.fs) as stored:
            for batch in stored.iter_batches(columns=STORED):
                offsets = pa.array(np.arange(place, place + batch.num_rows))
                numbers = pa.array(np.full(batch.num_rows, segment.partition, np.int32))
                yield pa.RecordBatch.from_arrays([numbers, offsets, *(batch[c] for c in STORED)], schema=SCHEMA)
                place += batch.num_rows

    def remove(self, written: list) -> None:
        for message in written:
            for s in message.segments if message is not None else []:
                self.fs.delete_file(f"{self.root}/segments/{s.file}")


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Segment]:
        log = LogFolder(self.path)
        return log.segments(0, log.last())

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # an empty log has no segment
            yield from LogFolder(self.path).rows_of(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, from_end: bool):
        self.path, self.from_end = path, from_end

    def initialOffset(self) -> dict:
        return {"commit": LogFolder(self.path).last() if self.from_end else 0}

    def latestOffset(self) -> dict:
        return {"commit": LogFolder(self.path).last()}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return LogFolder(self.path).segments(start["commit"], end["commit"])

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        yield from LogFolder(self.path).rows_of(partition)

    def commit(self, end: dict) -> None:
        """Positions are in the query's checkpoint."""


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return LogFolder(self.path).write_segments(iterator)

    def commit(self, messages: list) -> None:
        LogFolder(self.path).append([s for m in messages if m is not None for s in m.segments])

    def abort(self, messages: list) -> None:
        LogFolder(self.path).remove(messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, stream: str):
        self.path, self.stream = path, stream

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return LogFolder(self.path).write_segments(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        LogFolder(self.path).append([s for m in messages if m is not None for s in m.segments], self.stream, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        LogFolder(self.path).remove(messages)


class EdgeLog(DataSource):
    """Options: ``path``; for a stream reader ``startingOffsets`` (earliest, latest), for a writer ``stream``, its lasting name."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"], self.options.get("startingOffsets", "earliest") == "latest")

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a log can only be appended to")
        return _Writer(self.options["path"])

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self.options["path"], self.options.get("stream", "stream"))


def log_rows(messages: DataFrame, partition: Column, timestamp: Column) -> DataFrame:
    """``value`` of the messages as rows of a log; rows without a partition go to the first one."""
    return messages.select(
        F.coalesce(partition.cast("int"), F.lit(0)).alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
        F.col("value").cast("string").alias("value"),
    )


def append_log(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Append the rows of ``log_rows`` as one commit; their order in a partition is that of the frame's partitions."""
    spark.dataSource.register(EdgeLog)
    rows.write.format(FORMAT).mode("append").save(path)


def stream_log(rows: DataFrame, path: str, stream: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream of ``log_rows``, every batch once."""
    rows.sparkSession.dataSource.register(EdgeLog)
    writer = rows.writeStream.format(FORMAT).option("path", path).option("stream", stream)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(EdgeLog)
    return spark.read.format(FORMAT).load(path)


def follow_log(spark: SparkSession, path: str, starting: str = "earliest") -> DataFrame:
    """The log as a stream with the columns that ``topic_events`` takes."""
    spark.dataSource.register(EdgeLog)
    return spark.readStream.format(FORMAT).option("startingOffsets", starting).load(path)

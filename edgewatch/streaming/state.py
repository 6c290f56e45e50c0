"""Scorer state between micro-batches, as Parquet folders named by batch id, cut into hash buckets.

Each batch writes the counters it touched (a delta), sorted by bucket. Every ``compact_every`` batches the
deltas are merged into the base, a folder per bucket: only the buckets that the deltas touch are written
again. The clock is written last and names the folders that the state consists of, for each bucket its
own, so a batch without a clock never happened, a batch that runs again reads the same earlier state and
replaces its own folders, and no folder is ever searched for. What only earlier clocks name is deleted once
the next batch has begun.

A batch reads the base of the buckets its own entities fall into, and of the deltas only the row groups
that hold these buckets. Its cost follows from what it touches, not from the size of the state.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgewatch.operators.scoring import COUNTER_KEYS, VALUES, Clock
from edgewatch.session import delete_folder

CLOCK_SCHEMA = (
    "start bigint, max_tick bigint, max_rank bigint, newest bigint, "
    "bases map<int, bigint>, deltas array<bigint>, batch bigint"
)
BUCKETS = 256


def bucket_of(buckets: int, kind: Column, key1: Column, key2: Column, cell: Column) -> Column:
    """Bucket of an entity; nulls count like any other value."""
    return F.pmod(F.xxhash64(kind, key1.cast("string"), key2.cast("string"), cell.cast("bigint")), F.lit(buckets)).cast("int")


def touched_buckets(events: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The buckets of the edges, sources and destinations of ``events``; at most ``buckets`` numbers."""
    none = F.lit(None)
    entities = (("edge", F.col("src"), F.col("dst")), ("src", F.col("src"), none), ("dst", F.col("dst"), none))
    found = F.array(*[bucket_of(buckets, F.lit(kind), a, b, none) for kind, a, b in entities])
    return sorted(r[0] for r in events.select(F.explode(found).alias("b")).distinct().collect())


@dataclass(frozen=True)
class StateStore:
    spark: SparkSession
    path: str
    compact_every: int = 20
    buckets: int = BUCKETS

    def _clocks(self) -> list:
        """The clocks, oldest first: at most those since the one before the last."""
        try:
            clocks = self.spark.read.schema(CLOCK_SCHEMA).parquet(f"{self.path}/clock")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return clocks.orderBy("batch").collect()

    def clock_before(self, batch_id: int):
        """The row of the last clock before a batch, or None."""
        return next((c for c in reversed(self._clocks()) if c.batch < batch_id), None)

    def load(self, batch_id: int, touched: Iterable[int] | None = None) -> tuple[Clock | None, DataFrame | None]:
        """Clock and counters as they were before ``batch_id``, of the buckets ``touched`` or of all.

        An entity has a row per batch that touched it since its bucket's base; the highest ``batch`` holds.
        The scorer takes the rows of the entities it needs before it compares them.
        """
        row = self.clock_before(batch_id)
        if row is None:
            return None, None
        return Clock(row.start, row.max_tick, row.max_rank), self._rows(row.bases, row.deltas, touched)

    def _rows(self, bases: dict[int, int], deltas: list[int], touched: Iterable[int] | None = None) -> DataFrame | None:
        wanted = None if touched is None else set(touched)
        columns = [*COUNTER_KEYS, *VALUES]
        frames = []
        folders = [f"{self.path}/base/batch={b}/bucket={k}" for k, b in sorted(bases.items()) if wanted is None or k in wanted]
        if folders:  # an entity is in one bucket, and any delta is newer
            frames.append(self.spark.read.parquet(*folders).select(*columns, F.lit(-1).cast("bigint").alias("batch")))
        if deltas:
            reader = self.spark.read.option("basePath", f"{self.path}/delta")
            rows = reader.parquet(*[f"{self.path}/delta/batch={b}" for b in deltas])
            rows = rows if wanted is None else rows.filter(F.col("bucket").isin(sorted(wanted)))
            frames.append(rows.select(*columns, F.col("batch").cast("bigint").alias("batch")))
        return reduce(DataFrame.unionByName, frames) if frames else None

    def counters(self, batch_id: int) -> DataFrame:
        """All counters as they were before ``batch_id``, one row per entity."""
        row = self.clock_before(batch_id)
        return self._merged(self._rows(row.bases, row.deltas))

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*VALUES), "batch").alias("s")
        return rows.groupBy(*COUNTER_KEYS).agg(newest).select(*COUNTER_KEYS, "s.*")

    def save(self, batch_id: int, counters: DataFrame, clock: Clock, newest: int = 0) -> Clock:
        """Write what a batch left behind and return the clock with the ranks it used.

        ``newest`` is the latest event time of the stream so far.
        """
        delta = f"{self.path}/delta/batch={batch_id}"
        bucketed = counters.withColumn("bucket", bucket_of(self.buckets, *(F.col(k) for k in COUNTER_KEYS)))
        # sorted, so that a reader of few buckets finds them in few row groups
        bucketed.repartitionByRange("bucket", "kind").sortWithinPartitions("bucket", "kind").write.mode("overwrite").parquet(delta)
        rank = self.spark.read.parquet(delta).agg(F.max("rank")).first()[0]
        row = self.clock_before(batch_id)
        bases, deltas = (dict(row.bases), list(row.deltas)) if row is not None else ({}, [])
        clock = Clock(clock.start, clock.max_tick, max(int(rank or 0), clock.max_rank))
        deltas.append(batch_id)
        if len(deltas) >= self.compact_every:
            bases |= self._compact(batch_id, bases, deltas)
            deltas = []
        values = [(clock.start, clock.max_tick, clock.max_rank, newest, bases, deltas)]
        state = self.spark.createDataFrame(values, CLOCK_SCHEMA.removesuffix(", batch bigint")).coalesce(1)
        state.write.mode("overwrite").parquet(f"{self.path}/clock/batch={batch_id}")
        return clock

    def _compact(self, batch_id: int, bases: dict[int, int], deltas: list[int]) -> dict[int, int]:
        """Merge the deltas into the buckets they touch; the new folders of these buckets."""
        paths = [f"{self.path}/delta/batch={b}" for b in deltas]
        touched = [r[0] for r in self.spark.read.parquet(*paths).select("bucket").distinct().collect()]
        merged = self._merged(self._rows(bases, deltas, touched))
        merged = merged.withColumn("bucket", bucket_of(self.buckets, *(F.col(k) for k in COUNTER_KEYS)))
        # one task and one file per bucket; the scorer reads one kind at a time
        merged.repartition("bucket").sortWithinPartitions("bucket", "kind").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.path}/base/batch={batch_id}"
        )
        return dict.fromkeys(touched, batch_id)

    def clean_up(self, batch_id: int) -> None:
        """Delete what no clock from the last one before ``batch_id`` on can need.

        To be called when ``batch_id`` begins: earlier batches cannot run again then.
        """
        clocks = [c for c in self._clocks() if c.batch < batch_id]
        if not clocks:
            return
        last = clocks[-1]
        for old in clocks[:-1]:
            delete_folder(self.spark, f"{self.path}/clock/batch={old.batch}")
            for b in {*old.deltas, old.batch}.difference(last.deltas):
                delete_folder(self.spark, f"{self.path}/delta/batch={b}")
            for bucket, b in old.bases.items():
                if b not in last.bases.values():
                    delete_folder(self.spark, f"{self.path}/base/batch={b}")
                elif last.bases[bucket] != b:
                    delete_folder(self.spark, f"{self.path}/base/batch={b}/bucket={bucket}")
        if last.batch not in last.deltas:
            delete_folder(self.spark, f"{self.path}/delta/batch={last.batch}")

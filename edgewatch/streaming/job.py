"""Streaming scorer: edge events in, ``scores``, ``alerts`` and alert messages out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from edgewatch.config import ScorerConfig
from edgewatch.operators.alerts import alert_messages, alert_rows, score_rows
from edgewatch.operators.scoring import StreamProfile, profile_events, score_batch
from edgewatch.session import scratch_scope, shared_dir
from edgewatch.sinks.messages import write_message_files
from edgewatch.sinks.tables import write_table
from edgewatch.streaming.state import BUCKETS, StateStore, touched_buckets


@dataclass(frozen=True)
class ScoringJob:
    """Scores micro-batches with the batch kernel, starting from the counters of the batch before.

    Output folders are keyed by batch id and state is versioned with it, so a batch that is run again
    after a failure leaves the same rows once. ``publish`` receives the alert messages of a batch, again
    if the batch is run again (at least once); without it they are written to files under ``path``.

    An event whose timestamp is more than ``delay_seconds`` before the newest of all earlier batches is
    beyond the watermark. ``late`` says what becomes of it: "score" takes it like any other, "drop" leaves
    it out, "divert" leaves it out and writes it to ``path/late``. Without a delay nothing is beyond.
    """

    path: str
    cfg: ScorerConfig = field(default_factory=ScorerConfig)
    stream: str = "edges"
    compact_every: int = 20
    publish: Callable[[DataFrame, int], None] | None = None
    delay_seconds: int | None = None
    late: str = "score"
    buckets: int = BUCKETS

    def __post_init__(self) -> None:
        if self.late not in ("score", "drop", "divert"):
            raise ValueError("late must be 'score', 'drop' or 'divert'")
        if self.delay_seconds is not None and self.delay_seconds < 0:
            raise ValueError("the delay must not be negative")

    def process(self, events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        store = StateStore(spark, f"{self.path}/state", self.compact_every, self.buckets)
        events = events.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            row = store.clock_before(batch_id)
            timely, late = self._divided(events, row)
            profile = profile_events(timely, self.cfg)
            store.clean_up(batch_id)
            if late is not None and self.late == "divert":
                write_table(late.withColumn("event_time", F.timestamp_seconds("timestamp")), f"{self.path}/late", batch_id)
            if profile.rows == 0:
                return
            newest = max(profile.high, row.newest if row is not None else profile.high)
            with scratch_scope(spark):
                self._score(store, timely, profile, batch_id, newest)
            self._raise_alerts(spark, batch_id)
        finally:
            events.unpersist()

    def _divided(self, events: DataFrame, clock) -> tuple[DataFrame, DataFrame | None]:
        """Events up to the watermark of the batches before, and those beyond it."""
        if clock is None or self.delay_seconds is None or self.late == "score":
            return events, None
        beyond = F.coalesce(F.col("timestamp") < clock.newest - self.delay_seconds, F.lit(False))
        return events.filter(~beyond), events.filter(beyond)

    def _score(self, store: StateStore, events: DataFrame, profile: StreamProfile, batch_id: int, newest: int) -> None:
        # sketch cells are few and spread over all buckets
        touched = touched_buckets(events, self.buckets) if self.cfg.counts == "exact" else None
        clock, state = store.load(batch_id, touched)
        scoring, clock = score_batch(events, self.cfg, clock, state, profile)
        # scores and counters both come from the folds
        folds = [fold.persist(StorageLevel.MEMORY_AND_DISK) for _, fold in scoring.folds.values()]
        try:
            write_table(score_rows(scoring.scored), f"{self.path}/scores", batch_id)
            store.save(batch_id, scoring.counters(), clock, newest)
        finally:
            for fold in folds:
                fold.unpersist()

    def _raise_alerts(self, spark: SparkSession, batch_id: int) -> None:
        # from the rows just written, so nothing is scored twice
        scores = spark.read.parquet(f"{self.path}/scores/batch_id={batch_id}")
        scored = scores.select(
            F.col("id").alias("event_id"),
            "src",
            "dst",
            F.unix_seconds("event_time").alias("timestamp"),
            F.col("anomaly_score").alias("score"),
            "is_alert",
        )
        alerts = alert_rows(scored, self.stream)
        write_table(alerts, f"{self.path}/alerts", batch_id)
        publish = self.publish or self._write_messages
        publish(alert_messages(alerts), batch_id)

    def _write_messages(self, messages: DataFrame, batch_id: int) -> None:
        write_message_files(messages, f"{self.path}/messages", batch_id)

    def start(self, events: DataFrame, **trigger) -> StreamingQuery:
        """Run on a streaming frame, for example with ``availableNow=True``."""
        writer = events.writeStream.foreachBatch(self.process)
        writer = writer.option("checkpointLocation", f"{self.path}/checkpoint")
        return (writer.trigger(**trigger) if trigger else writer).start()


def scoring_job(spark: SparkSession, name: str, cfg: ScorerConfig | None = None, **options) -> ScoringJob:
    """A job that keeps its tables, state and checkpoint in the cluster's shared folder."""
    return ScoringJob(f"{shared_dir(spark)}/{name}", cfg or ScorerConfig(), **options)

"""The trailing alert rate of a stream of alerts, kept up to date while alerts arrive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def sliding_alert_rate(alerts: DataFrame, seconds: int = 1, delay: str = "10 seconds") -> DataFrame:
    """``second, alerts`` as in ``alert_rate``, from a streaming frame with ``event_time``.

    Windows of ``seconds + 1`` whole seconds slide by one. A window stands for its last second and counts
    only if that second has an alert of its own. In update mode a second appears again when an alert is
    added to it; alerts more than ``delay`` behind the newest are left out and their windows forgotten.
    """
    second = F.unix_seconds("event_time")
    window = F.window("event_time", f"{seconds + 1} seconds", "1 second").alias("w")
    counted = alerts.withWatermark("event_time", delay).groupBy(window).agg(
        F.count(F.lit(1)).alias("alerts"), F.max(second).alias("newest")
    )
    last = F.unix_seconds(F.col("w.end")) - 1
    return counted.filter(F.col("newest") == last).select(last.alias("second"), "alerts")


@dataclass(frozen=True)
class RateTable:
    """Updates of a sliding rate, a folder per micro-batch that a repeated batch replaces."""

    path: str

    def start(self, alerts: DataFrame, seconds: int = 1, delay: str = "10 seconds", **trigger) -> StreamingQuery:
        def put(rows: DataFrame, batch_id: int) -> None:
            rows.write.mode("overwrite").parquet(f"{self.path}/updates/batch_id={batch_id}")

        writer = sliding_alert_rate(alerts, seconds, delay).writeStream.outputMode("update").foreachBatch(put)
        return writer.option("checkpointLocation", f"{self.path}/checkpoint").trigger(**trigger).start()

    def read(self, spark: SparkSession) -> DataFrame:
        """``second, alerts`` after the last batch."""
        updates = spark.read.parquet(f"{self.path}/updates")
        return updates.groupBy("second").agg(F.max_by("alerts", "batch_id").alias("alerts"))

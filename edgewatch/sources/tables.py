"""Reading the ``scores`` and ``alerts`` tables back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from edgewatch.schemas import ALERT_TABLE_SCHEMA, SCORE_TABLE_SCHEMA
from edgewatch.sinks.compaction import read_table


def read_scores(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """``batch_id`` tells which micro-batch wrote a row. The days from ``first`` to ``last``, or all."""
    return _rows(spark, path, first, last).select(*SCORE_TABLE_SCHEMA.fieldNames(), "event_date", "batch_id")


def read_alerts(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    return _rows(spark, path, first, last).select(*ALERT_TABLE_SCHEMA.fieldNames(), "event_id", "event_date", "batch_id")


def _rows(spark: SparkSession, path: str, first: date | None, last: date | None) -> DataFrame:
    rows = read_table(spark, path, first, last)
    return spark.read.parquet(path) if rows is None else rows


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 8,
    **options: str,
) -> DataFrame:
    """A database table, read in parallel ranges of ``partition_column`` if one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()

"""Streaming edge sources. Both yield ``src, dst, timestamp, label, event_id``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgewatch.operators.edges import MISSING_ADDRESS
from edgewatch.schemas import LABELLED_EDGE_SCHEMA

EVENT_SCHEMA = T.StructType([*LABELLED_EDGE_SCHEMA.fields, T.StructField("event_id", T.LongType())])
OFFSET_BITS = 48
CORRUPT = "_malformed"


def _parsed(raw: DataFrame) -> DataFrame:
    schema = T.StructType([*LABELLED_EDGE_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return raw.select(F.from_json(text, schema, options).alias("e"), text.alias("_text"), "*")


def _is_malformed() -> Column:
    return F.col("e").isNull() | F.col(f"e.{CORRUPT}").isNotNull() | F.col("e.timestamp").isNull()


def decode_events(raw: DataFrame, malformed: str = "fail") -> DataFrame:
    """JSON text in ``value`` as a struct ``e`` beside the other columns; a missing id is ``0.0.0.0``.

    ``malformed`` "fail" stops at a message that is no such JSON or has no time; "quarantine" leaves it
    out (see ``malformed_events``).
    """
    if malformed not in ("fail", "quarantine"):
        raise ValueError("malformed must be 'fail' or 'quarantine'")
    rows = _parsed(raw)
    bad = _is_malformed()
    if malformed == "fail":
        message = F.concat(F.lit("malformed message "), F.coalesce("_text", F.lit("null")))
        bad = F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(False))
    fields = []
    for field in LABELLED_EDGE_SCHEMA.fields:
        value = F.col(f"e.{field.name}")
        fields.append((F.coalesce(value, F.lit(MISSING_ADDRESS)) if field.name in ("src", "dst") else value).alias(field.name))
    return rows.filter(~bad).select(F.struct(*fields).alias("e"), *raw.columns)


def malformed_events(raw: DataFrame) -> DataFrame:
    """The messages that ``decode_events(malformed="quarantine")`` leaves out, as they came."""
    return _parsed(raw).filter(_is_malformed()).select(*raw.columns)


def kafka_edges(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    malformed: str = "fail",
    **options: str,
) -> DataFrame:
    """Edge events of a topic, with ``event_id`` and ``arrival`` (see ``topic_events``).

    Offsets are kept in the query's checkpoint. Needs the Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
    )
    return topic_events(reader.load(), malformed)


def topic_events(raw: DataFrame, malformed: str = "fail") -> DataFrame:
    """Records of a topic as edge events.

    ``event_id`` combines partition and offset and only identifies the event. Arrival order over all
    partitions is that of ``arrival``: record time, then partition and offset
    (``ScorerConfig(order="arrival", arrival="arrival")``).
    """
    place = F.shiftleft(F.col("partition").cast("bigint"), OFFSET_BITS) + F.col("offset")
    arrived = F.struct(
        F.unix_micros(F.col("_record.timestamp")).alias("at"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
    )
    record = F.struct("timestamp").alias("_record")
    events = decode_events(raw.select("value", "partition", "offset", record), malformed)
    return events.select("e.*", place.alias("event_id"), arrived.alias("arrival"))


def file_edges(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Edge events from JSON files as they appear; ``event_id`` is a field of the event."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)

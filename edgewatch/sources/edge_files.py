"""Edge streams in CSV files: with or without header, labels inside or in a second file."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgewatch.functions.ordering import with_row_index
from edgewatch.operators.edges import MISSING_ADDRESS

# Words that mark a first row as a header, and accepted column names.
EDGE_HEADER_WORDS = ("src", "source", "dst", "destination", "timestamp")
LABEL_HEADER_WORDS = ("label", "ground_truth", "is_anomaly")
SOURCE_NAMES = ("src", "source")
DESTINATION_NAMES = ("dst", "destination")
TIMESTAMP_NAMES = ("timestamp",)

CORRUPT = "_malformed"


def first_fields(spark: SparkSession, path: str) -> list[str]:
    """Fields of the first line of a file; for a folder or glob, of one of its files."""
    lines = spark.read.text(path).filter(F.col("_metadata.file_block_start") == 0)
    row = lines.select("value").limit(1).first()
    if row is None:
        raise ValueError(f"{path} is empty")
    return [f.strip() for f in next(csv.reader([row.value]))]


def has_header(fields: list[str], words: tuple[str, ...] = EDGE_HEADER_WORDS) -> bool:
    return any(f.lower() in words for f in fields)


def _position(fields: list[str], names: tuple[str, ...], default: int) -> int:
    lowered = [f.lower() for f in fields]
    return next((lowered.index(n) for n in names if n in lowered), default)


def _scan(spark: SparkSession, path: str, fields: int, header: bool) -> DataFrame:
    """Text columns ``c0, c1, ...``; the whole line where its number of fields is another one."""
    columns = [T.StructField(f"c{i}", T.StringType()) for i in range(fields)]
    schema = T.StructType([*columns, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.option("header", header).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("mode", "PERMISSIVE").schema(schema).csv(path)


def _is_short(fields: int) -> Column:
    """Fewer fields than the first line; more are no fault, the first ones count."""
    return F.col(CORRUPT).isNotNull() & F.col(f"c{fields - 1}").isNull()


def _refuse(rows: DataFrame, bad: Column) -> DataFrame:
    """``rows``, with an error as soon as one of them is bad."""
    message = F.concat(F.lit("malformed row "), F.col("row_idx").cast("string"))
    return rows.filter(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def read_edges(
    spark: SparkSession,
    path: str,
    header: str | bool = "auto",
    labelled: bool | None = None,
    malformed: str = "fail",
) -> DataFrame:
    """``src, dst, timestamp, event_id[, label]``; ``event_id`` is the 0-based row number.

    ``header`` "auto" looks at the first line. Columns are found by name, or by position where a
    name is missing. ``malformed`` "fail" stops at a row with too few fields or without a time, an
    empty id is ``0.0.0.0``; "quarantine" keeps such rows and rows without ids out (see
    ``malformed_rows``). Fields beyond those of the first line are ignored. ``labelled`` None means: if
    the file has a fourth column.
    """
    if malformed not in ("fail", "quarantine"):
        raise ValueError("malformed must be 'fail' or 'quarantine'")
    fields = first_fields(spark, path)
    with_header = has_header(fields) if header == "auto" else bool(header)
    names = fields if with_header else []
    at = [
        _position(names, SOURCE_NAMES, 0),
        _position(names, DESTINATION_NAMES, 1),
        _position(names, TIMESTAMP_NAMES, 2),
    ]
    if len(fields) <= max(at):
        raise ValueError(f"{path}: expected at least {max(at) + 1} columns, got {len(fields)}")
    rows = with_row_index(_scan(spark, path, len(fields), with_header))
    if malformed == "quarantine":
        rows = rows.filter(~_is_malformed(at, len(fields)))
    else:
        rows = _refuse(rows, _is_short(len(fields)) | F.col(f"c{at[2]}").try_cast("double").isNull())
    label_at = _position(names, LABEL_HEADER_WORDS[:1], 3)
    labelled = len(fields) > label_at if labelled is None else labelled
    columns = [
        F.coalesce(f"c{at[0]}", F.lit(MISSING_ADDRESS)).alias("src"),
        F.coalesce(f"c{at[1]}", F.lit(MISSING_ADDRESS)).alias("dst"),
        F.floor(F.col(f"c{at[2]}").try_cast("double")).cast("bigint").alias("timestamp"),
        F.col("row_idx").alias("event_id"),
    ]
    if labelled:
        columns.append(F.col(f"c{label_at}").cast("smallint").alias("label"))
    return rows.select(*columns)


def _is_malformed(at: list[int], fields: int) -> Column:
    missing = F.col(f"c{at[0]}").isNull() | F.col(f"c{at[1]}").isNull()
    number = F.col(f"c{at[2]}").try_cast("double")
    return _is_short(fields) | missing | number.isNull()


def malformed_rows(spark: SparkSession, path: str, header: str | bool = "auto") -> DataFrame:
    """``row_idx, line`` of the rows that ``read_edges(malformed="quarantine")`` leaves out."""
    fields = first_fields(spark, path)
    with_header = has_header(fields) if header == "auto" else bool(header)
    names = fields if with_header else []
    at = [
        _position(names, SOURCE_NAMES, 0),
        _position(names, DESTINATION_NAMES, 1),
        _position(names, TIMESTAMP_NAMES, 2),
    ]
    rows = with_row_index(_scan(spark, path, len(fields), with_header))
    whole = F.concat_ws(",", *[F.col(f"c{i}") for i in range(len(fields))])
    line = F.coalesce(F.col(CORRUPT), whole)
    return rows.filter(_is_malformed(at, len(fields))).select("row_idx", line.alias("line"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """``row_idx, label`` of a label file; the label is the last column, a header is skipped."""
    fields = first_fields(spark, path)
    header = fields[0].lower() in LABEL_HEADER_WORDS
    rows = with_row_index(_scan(spark, path, len(fields), header))
    rows = _refuse(rows, _is_short(len(fields)))
    return rows.select("row_idx", F.col(f"c{len(fields) - 1}").cast("smallint").alias("label"))


def attach_labels(
    events: DataFrame, labels: DataFrame, row_idx: str = "event_id", allow_longer: bool = False
) -> DataFrame:
    """Label of row N to event N.

    The numbers of rows must agree; with ``allow_longer`` there may be more labels than events. They
    are compared before the join, so no row is dropped unnoticed.
    """
    n_events, n_labels = events.count(), labels.count()
    if n_labels < n_events or (n_labels != n_events and not allow_longer):
        raise ValueError(f"{n_events} events but {n_labels} labels")
    return events.join(labels.withColumnRenamed("row_idx", row_idx), row_idx)

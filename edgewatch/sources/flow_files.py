"""Labelled flow records: many CSV files of differing encoding and header, or processed Parquet."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgewatch.functions.ordering import with_scan_order
from edgewatch.operators.replay import sample_per_file

LOAD_ORDER = ["_file", "_block", "_seq"]
FALLBACK_ENCODING = "ISO-8859-1"


@dataclass(frozen=True)
class FileGroup:
    """Files that share an encoding and a header."""

    encoding: str
    names: tuple[str, ...]
    files: tuple[str, ...]


def find_files(spark: SparkSession, *patterns: str) -> list[str]:
    """Files matching any of the patterns, each once, sorted. Patterns without a match are skipped."""
    found: set[str] = set()
    for pattern in patterns:
        try:
            found.update(spark.read.text(pattern).inputFiles())
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        raise FileNotFoundError(f"no files match {', '.join(patterns)}")
    return sorted(found)


def unique_names(fields: list[str]) -> tuple[str, ...]:
    """Header names with repeats numbered: ``a, a`` becomes ``a, a.1``."""
    counts: dict[str, int] = {}
    out = []
    for field in fields:
        seen = counts.get(field, 0)
        counts[field] = seen + 1
        out.append(field if not seen else f"{field}.{seen}")
    return tuple(out)


def inspect_files(spark: SparkSession, files: list[str]) -> list[FileGroup]:
    """Header and encoding of every file, from one scan that returns one row per file."""
    lines = spark.read.text(files).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        ).alias("place"),
    )
    facts = lines.groupBy("file").agg(
        F.min_by("value", "place").alias("header"),
        F.min(F.is_valid_utf8("value")).alias("utf8"),
    )
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for row in facts.collect():
        encoding = "UTF-8" if row.utf8 else FALLBACK_ENCODING
        # compared after trimming, because that is how columns are matched later
        fields = [f.strip() for f in next(csv.reader([row.header]))]
        groups.setdefault((encoding, unique_names(fields)), []).append(row.file)
    return [FileGroup(e, n, tuple(sorted(files))) for (e, n), files in sorted(groups.items())]


def read_flow_files(
    spark: SparkSession, *patterns: str, sample: int | None = None, seed: int = 42
) -> DataFrame:
    """All columns as text, stacked by name, plus the load order ``_file, _block, _seq``."""
    groups = inspect_files(spark, find_files(spark, *patterns))
    parts = []
    for group in groups:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in group.names])
        reader = spark.read.option("header", True).option("encoding", group.encoding)
        parts.append(with_scan_order(reader.schema(schema).csv(list(group.files))))
    flows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if sample is not None:
        flows = sample_per_file(flows, "_file", sample, LOAD_ORDER, seed)
    return flows


def read_flows(spark: SparkSession, path: str) -> DataFrame:
    """Processed flows, Parquet or, by extension, CSV with a header."""
    if path.endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.parquet(path)

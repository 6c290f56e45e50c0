"""Tables that are written a batch at a time, merged into one folder per day.

``write_table`` leaves ``batch_id=N/event_date=D`` folders: many small files, and a day's rows lie below
every batch. Compaction moves the rows of whole batches into ``_days/version=V/event_date=D``. A manifest
says which version holds each day and up to which batch its rows are there; it is written last, so a
compaction that fails leaves the table as it was. Days without new rows keep the version they have.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgewatch.session import delete_folder

MANIFEST = "version bigint, upto bigint, days map<date, bigint>"


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers N of the folders ``prefix=N`` below a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    names = [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()]
    return sorted(int(n.removeprefix(f"{prefix}=")) for n in names if n.startswith(f"{prefix}="))


def manifest(spark: SparkSession, path: str):
    """``version, upto, days`` of the last compaction, or None."""
    versions = _folders(spark, f"{path}/_manifest", "version")
    for version in reversed(versions):
        try:
            row = spark.read.schema(MANIFEST.removeprefix("version bigint, ")).parquet(f"{path}/_manifest/version={version}").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            row = None
        if row is not None:
            return version, row.upto, dict(row.days)
    return None


def read_table(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame | None:
    """All rows with ``event_date`` and ``batch_id``; the days from ``first`` to ``last`` read only their own folders."""
    state = manifest(spark, path)
    _, upto, days = state if state else (None, -1, {})
    wanted = sorted(d for d in days if (first is None or d >= first) and (last is None or d <= last))
    frames = []
    if wanted:
        folders = [f"{path}/_days/version={days[d]}/event_date={d}" for d in wanted]
        frames.append(spark.read.option("basePath", f"{path}/_days").parquet(*folders).drop("version"))
    fresh = [f"{path}/batch_id={b}" for b in _folders(spark, path, "batch_id") if b > upto]
    if fresh:
        rows = spark.read.option("basePath", path).parquet(*fresh)
        if first is not None:
            rows = rows.filter(F.col("event_date") >= F.lit(first))
        if last is not None:
            rows = rows.filter(F.col("event_date") <= F.lit(last))
        frames.append(rows)
    if len(frames) < 2:
        return frames[0] if frames else None
    return frames[0].unionByName(frames[1].select(*frames[0].columns))


def compact_table(spark: SparkSession, path: str, upto: int) -> None:
    """Merge the batches up to ``upto``, which must not be written again, into the days they touch.

    Their folders are deleted when the manifest no longer needs them, and with them the versions of days
    that have been replaced. A reader that holds the manifest before the last keeps its files until then.
    """
    state = manifest(spark, path)
    version, done, days = state if state else (-1, -1, {})
    batches = [b for b in _folders(spark, path, "batch_id") if done < b <= upto]
    if not batches:
        return
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={b}" for b in batches])
    touched = [r[0] for r in rows.select("event_date").distinct().collect()]
    held = [f"{path}/_days/version={days[d]}/event_date={d}" for d in touched if d in days]
    if held:
        earlier = spark.read.option("basePath", f"{path}/_days").parquet(*held)
        rows = rows.unionByName(earlier.select(*rows.columns))
    # a day's rows go to as many tasks as AQE finds fit for their size
    merged = rows.hint("rebalance", "event_date")
    merged.write.mode("overwrite").partitionBy("event_date").parquet(f"{path}/_days/version={version + 1}")
    now = days | dict.fromkeys(touched, version + 1)
    state = spark.createDataFrame([(upto, now)], MANIFEST.removeprefix("version bigint, ")).coalesce(1)
    state.write.mode("overwrite").parquet(f"{path}/_manifest/version={version + 1}")
    for b in _folders(spark, path, "batch_id"):
        if b <= done:  # what the manifest before this one has merged
            delete_folder(spark, f"{path}/batch_id={b}")
    for old in _folders(spark, f"{path}/_manifest", "version"):
        if old < version:
            delete_folder(spark, f"{path}/_manifest/version={old}")
    for old in _folders(spark, f"{path}/_days", "version"):
        if old not in {*now.values(), *days.values()}:
            delete_folder(spark, f"{path}/_days/version={old}")

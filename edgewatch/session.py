"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "edgewatch", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else the session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"


_SCOPES: list[list[str]] = []
#: Spark's setting that removes the shuffle files of a query as soon as it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str, drop_shuffles: bool = False, compression: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage for good.

    ``drop_shuffles`` removes the shuffle files of the write at its end; else they stay on disk until the
    driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/edgewatch/{label}-{uuid.uuid4().hex}"
    with _shuffle_cleanup(spark) if drop_shuffles else nullcontext():
        df.write.parquet(path, compression=compression)
    for scope in _SCOPES[-1:]:
        scope.append(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


@contextmanager
def _shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def release(stored: DataFrame) -> None:
    """Delete the folder of a frame that ``materialize`` returned and that nothing reads any more."""
    delete_folder(stored.sparkSession, stored._stored_at)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the package's own, wherever the session's file systems keep it."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def keep_after_scope(stored: DataFrame) -> DataFrame:
    """Let a table outlive the innermost ``scratch_scope``; the scope around that one owns it then."""
    for scope in _SCOPES[-1:]:
        scope.remove(stored._stored_at)
    for scope in _SCOPES[-2:-1]:
        scope.append(stored._stored_at)
    return stored


def kept_after_scope(df: DataFrame, label: str) -> DataFrame:
    """``df``, written now, as a table that the innermost ``scratch_scope`` leaves alone."""
    return keep_after_scope(materialize(df, label))


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes what ``materialize`` writes inside, once everything that reads it has been written."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete_folder(spark, path)

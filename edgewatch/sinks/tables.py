"""Writing flows, scores and alerts as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_flows(flows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Cleaned flows as snappy Parquet."""
    flows.write.mode(mode).option("compression", "snappy").parquet(path)


def write_table(rows: DataFrame, path: str, batch_id: int = 0) -> None:
    """One folder per batch, inside it one per day. Writing a batch again replaces its folder."""
    dated = rows.withColumn("event_date", F.to_date("event_time"))
    dated.write.mode("overwrite").partitionBy("event_date").parquet(f"{path}/batch_id={batch_id}")


def flat_columns(rows: DataFrame) -> DataFrame:
    """Arrays as JSON text, for databases without arrays."""
    arrays = [f.name for f in rows.schema.fields if f.dataType.typeName() == "array"]
    return rows.withColumns({c: F.to_json(c) for c in arrays}) if arrays else rows


def write_jdbc(rows: DataFrame, url: str, table: str, batch_size: int = 10_000, **options: str) -> None:
    """Append to a database table in batches; arrays are sent as JSON text."""
    (
        flat_columns(rows).write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .options(**options)
        .save()
    )

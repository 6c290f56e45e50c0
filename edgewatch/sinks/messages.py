"""Writing JSON messages, to a topic or to files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_kafka(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """The ``value`` column as one record per row. Needs the Kafka connector on the class path."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )


def write_message_files(messages: DataFrame, path: str, batch_id: int = 0) -> None:
    """The ``value`` column as text files, one folder per batch, replaced when written again."""
    messages.select("value").write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

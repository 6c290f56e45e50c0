"""Generated edge streams for tests and for the benchmark's published workload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _uniform(salt: int, seed: int, low: int, high: int) -> Column:
    """Whole number in [low, high] from a hash of the row number, the same in every run."""
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), F.col("id")), F.lit(high - low + 1))
    return (drawn + low).cast("bigint")


def burst_traffic(
    spark: SparkSession, background: int = 500, burst: int = 40, start: int = 1_700_000_000, seed: int = 42
) -> DataFrame:
    """Labelled traffic: random pairs for 550 s, then one pair repeated within 5 s from second 560."""
    noise = spark.range(background).select(
        F.concat(F.lit("192.168.1."), _uniform(1, seed, 1, 50)).alias("src"),
        F.concat(F.lit("10.0.0."), _uniform(2, seed, 1, 50)).alias("dst"),
        (F.lit(start) + _uniform(3, seed, 0, 550)).alias("timestamp"),
        F.lit(0).cast("smallint").alias("label"),
        F.col("id").alias("event_id"),
    )
    attack = spark.range(burst).select(
        F.lit("192.168.1.666").alias("src"),
        F.lit("10.0.0.99").alias("dst"),
        (F.lit(start + 560) + _uniform(4, seed, 0, 5)).alias("timestamp"),
        F.lit(1).cast("smallint").alias("label"),
        (F.col("id") + background).alias("event_id"),
    )
    return noise.unionByName(attack)


def steady_traffic(
    spark: SparkSession,
    events: int = 1_000_000,
    burst_start: int = 500_000,
    burst_length: int = 10_000,
    rate: int = 100,
    pairs: int = 100,
    start: int = 1_700_000_000,
) -> DataFrame:
    """``rate`` events per second from one of ``pairs`` pairs at a time, with one pair's burst inside."""
    i = F.col("id")
    in_burst = (i >= burst_start) & (i < burst_start + burst_length)
    pair = F.pmod(F.floor(i / F.lit(rate)), F.lit(pairs)).cast("bigint")
    host = F.when(in_burst, F.lit(255)).otherwise(pair).cast("string")
    return spark.range(events).select(
        F.concat(F.lit("192.168.1."), host).alias("src"),
        F.concat(F.lit("10.0.0."), host).alias("dst"),
        (F.lit(start) + F.floor(i / F.lit(rate))).cast("bigint").alias("timestamp"),
        i.alias("event_id"),
        in_burst.cast("smallint").alias("label"),
    )

"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """A column by its literal name; flow columns contain blanks, slashes and dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def bucket_of(timestamp: Column, origin: Column | int, width: int) -> Column:
    """0-based fixed window counted from ``origin``."""
    return F.floor((timestamp - origin) / F.lit(width)).cast("bigint")


def tick_of(timestamp: Column, origin: Column | int, width: int) -> Column:
    """1-based tick; anything before ``origin`` belongs to tick 1."""
    return F.greatest(F.lit(0), bucket_of(timestamp, origin, width)).cast("bigint") + F.lit(1)


def chi_squared_sql(current: str, total: str, tick: str) -> str:
    """How far ``current`` lies from the mean per tick, ``total / tick``, as a chi-squared statistic.

    0 without history, in the first tick, and for an entity that was not seen.
    """
    gap = f"({current} - {total} / {tick})"
    return (
        f"CASE WHEN {total} > 0 AND {tick} > 1 AND {current} > 0 THEN "
        f"{gap} * {gap} * {tick} * {tick} / ({total} * ({tick} - 1)) ELSE 0D END"
    )


def chi_squared(current: str, total: str, tick: str) -> Column:
    return F.expr(chi_squared_sql(current, total, tick))


def uuid_from(*parts: Column) -> Column:
    """UUID-shaped identifier that depends on ``parts`` only, so a rerun writes the same one."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def event_seconds(timestamp: Column) -> Column:
    """Epoch second of a timestamp, rounded down."""
    return F.floor(F.unix_micros(timestamp.cast("timestamp")) / F.lit(1_000_000)).cast("bigint")


def finite(column: Column) -> Column:
    """The number itself, or null where it is NaN or infinite."""
    return F.when(F.isnan(column) | (F.abs(column) == F.lit(float("inf"))), None).otherwise(column)

"""Cleaning of labelled flow records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewatch.functions.ordering import exact_quantiles
from edgewatch.functions.scalar import finite, named
from edgewatch.schemas import BENIGN, LABEL_CLASSES, NUMERIC_FEATURES, TIMESTAMP_FORMATS
from edgewatch.session import materialize


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip blanks around column names; names that then collide get a number, first one excepted."""
    seen: dict[str, int] = {}
    names = []
    for column in df.columns:
        name = column.strip()
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}.{seen[name] - 1}")
    return df.toDF(*names)


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def label_class(label: Column) -> Column:
    """Class of a raw label, null if it is unknown."""
    pairs = [F.lit(x) for pair in LABEL_CLASSES.items() for x in pair]
    return F.element_at(F.create_map(*pairs), F.trim(label))


def normalize_labels(df: DataFrame, unknown: str = "benign") -> DataFrame:
    """Map ``Label`` to its class and add ``is_attack`` and ``attack_type``.

    Unknown and missing labels become Benign ("benign"), stay as they are ("keep"), or fail ("error").
    """
    require_columns(df, "Label")
    raw = F.trim("Label")
    fallback = {
        "benign": F.lit(BENIGN),
        "keep": F.coalesce(raw, F.lit(BENIGN)),
        "error": F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(raw, F.lit("null")))),
    }
    if unknown not in fallback:
        raise ValueError(f"unknown must be one of {tuple(fallback)}")
    known = label_class(F.col("Label"))
    if unknown == "error":
        label = F.when(known.isNull(), fallback["error"].cast("string")).otherwise(known)
    else:
        label = F.coalesce(known, fallback[unknown])
    return df.withColumn("Label", label).withColumns(
        {"is_attack": F.col("Label") != BENIGN, "attack_type": F.col("Label")}
    )


def unknown_labels(df: DataFrame) -> DataFrame:
    """``label, rows`` of labels that no class is known for."""
    return (
        df.filter(label_class(F.col("Label")).isNull())
        .groupBy(F.trim("Label").alias("label"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c in NUMERIC_FEATURES if c in df.columns]


def coerce_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as doubles; text that is no number and infinite or NaN values become null."""
    return df.withColumns({c: finite(named(c).try_cast("double")) for c in columns})


def column_medians(
    df: DataFrame, columns: list[str], exact: bool = True, rows: int | None = None
) -> dict[str, float]:
    """Median of each column that has any value. The result is one number per column."""
    if exact:
        found = exact_quantiles(df, columns, [0.5], rows=rows).select("feature", "q0").collect()
        return {r.feature: r.q0 for r in found}
    plain = [f"_c{i}" for i in range(len(columns))]
    narrow = df.select(*[named(c).alias(p) for c, p in zip(columns, plain)])
    found = narrow.approxQuantile(plain, [0.5], 0.001)
    return {c: q[0] for c, q in zip(columns, found) if q}


def fill_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Null and NaN become the column's median."""
    filled = {c: F.coalesce(F.nanvl(named(c).cast("double"), F.lit(None)), F.lit(m)) for c, m in medians.items()}
    return df.withColumns(filled)


def impute_medians(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Numbers only, gaps filled with the column's median over all rows; an empty column stays null."""
    columns = numeric_columns(df) if columns is None else columns
    if not columns:
        return df
    # written once: parsing and coercion are not repeated by the passes of the quantiles
    numbers = materialize(coerce_numbers(df, columns), "numbers")
    return fill_medians(numbers, column_medians(numbers, columns, exact))


def parse_timestamps(column: Column) -> Column:
    """The first known layout that fits."""
    return F.coalesce(*[F.try_to_timestamp(column, F.lit(f)) for f in TIMESTAMP_FORMATS])


def drop_duplicate_flows(
    df: DataFrame, load_order: list[str], ignore_columns: tuple[str, ...] = ("Timestamp",)
) -> DataFrame:
    """Rows equal in all but ``ignore_columns``, reduced to the first in load order.

    A grouped aggregate, so copies are combined before the shuffle. Nulls equal each other.
    """
    ignored = [c for c in ignore_columns if c in df.columns]
    keys = [c for c in df.columns if c not in ignored and c not in load_order]
    place = F.struct(*load_order)
    first = [F.min_by(named(c), place).alias(c) for c in ignored]
    order = F.min(place).alias("_first")
    grouped = df.groupBy(*[named(c) for c in keys]).agg(*first, order)
    restored = [F.col("_first")[c].alias(c) for c in load_order]
    columns = [named(c) for c in df.columns if c not in load_order]
    return grouped.select(*columns, *restored)


def clean_flows(
    df: DataFrame,
    load_order: list[str],
    unknown: str = "benign",
    exact: bool = True,
    ignore_columns: tuple[str, ...] = ("Timestamp",),
) -> DataFrame:
    """Names, labels, numbers, timestamps, duplicates, in that order. ``load_order`` is kept."""
    df = normalize_labels(require_columns(trim_column_names(df), "Label"), unknown)
    df = impute_medians(df, exact=exact)
    if "Timestamp" in df.columns:
        df = df.withColumn("Timestamp", parse_timestamps(F.col("Timestamp").cast("string")))
    return drop_duplicate_flows(df, load_order, ignore_columns)


def class_counts(flows: DataFrame) -> DataFrame:
    return flows.groupBy("attack_type").agg(F.count(F.lit(1)).alias("rows"))


def dataset_summary(flows: DataFrame, files_loaded: int | None = None) -> DataFrame:
    """One row: total, benign and attack rows, rows per class, known numeric columns, files."""
    benign = F.col("attack_type") == BENIGN
    entries = F.sort_array(F.collect_list(F.struct("attack_type", "rows")))
    # collects one entry per class, not rows
    return class_counts(flows).agg(
        F.sum("rows").alias("total_rows"),
        F.sum(F.when(benign, F.col("rows")).otherwise(0)).alias("benign_rows"),
        F.sum(F.when(benign, 0).otherwise(F.col("rows"))).alias("attack_rows"),
        F.map_from_entries(entries).alias("attack_types"),
        F.lit(len(numeric_columns(flows))).alias("numeric_columns"),
        F.lit(files_loaded).cast("int").alias("files_loaded"),
    )

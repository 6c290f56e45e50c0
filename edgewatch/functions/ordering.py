"""Positions, prefix sums and exact order statistics that never sort a whole table in one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgewatch.functions.scalar import named
from edgewatch.functions.sizing import join_sized
from edgewatch.session import materialize

POSITION_BLOCK = 4096
ROWS_PER_SLICE = 100_000
SLICES = 1_024
SAMPLED_PER_SLICE = 500


# --- row positions -------------------------------------------------------------------------------


def with_scan_order(df: DataFrame, parquet: bool = False) -> DataFrame:
    """Add ``_file``, ``_block`` and ``_seq``: where the scan found each row.

    Must be applied straight to a file scan. A CSV row is known by its split and by its place in
    that split; a Parquet row by its row number in the file.
    """
    if parquet:
        return df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.lit(0).cast("bigint").alias("_block"),
            F.col("_metadata.row_index").alias("_seq"),
        )
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    )


def with_row_index(scan: DataFrame, parquet: bool = False) -> DataFrame:
    """Add ``row_idx``, the 0-based position of each row over all files in path order.

    Rows are counted per split and the counts summed over the list of splits. A split's rows follow one
    another in the scan, so its first number gives the others their place without a shuffle.
    """
    ordered = with_scan_order(scan, parquet)
    split = ["_file", "_block"]
    rows = F.max("_seq") + 1 if parquet else F.count(F.lit(1))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(*split)
        .agg(rows.alias("_rows"), (F.lit(0) if parquet else F.min("_seq")).cast("bigint").alias("_first"))
        .select(*split, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    splits = len(scan.inputFiles()) + scan.rdd.getNumPartitions()
    return (
        join_sized(ordered, offsets, split, splits)
        .withColumn("row_idx", (F.col("_offset") + F.col("_seq") - F.col("_first")).cast("bigint"))
        .drop("_offset", "_first", "_seq", *split)
    )


def with_prefix_sums(df: DataFrame, position: str, columns: list[str]) -> DataFrame:
    """Add ``<c>_before``, the sum of ``c`` over all smaller positions.

    ``df`` has one row per position. Positions are summed inside blocks and the blocks then summed
    among themselves, so no task sees more than a block or the list of blocks.
    """
    block = F.floor(F.col(position) / F.lit(POSITION_BLOCK)).alias("_block")
    in_block = (
        Window.partitionBy("_block")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocked = df.select("*", block)
    totals = blocked.groupBy("_block").agg(*[F.sum(c).alias(c) for c in columns])
    offsets = totals.select("_block", *[F.sum(c).over(earlier).alias(f"_off_{c}") for c in columns])
    out = blocked.select("*", *[F.sum(c).over(in_block).alias(f"_in_{c}") for c in columns])
    out = out.join(offsets, "_block")
    for c in columns:
        zero = F.lit(0)
        total = F.coalesce(F.col(f"_in_{c}"), zero) + F.coalesce(F.col(f"_off_{c}"), zero)
        out = out.withColumn(f"{c}_before", total)
    return out.drop("_block", *[f"_in_{c}" for c in columns], *[f"_off_{c}" for c in columns])


def dense_ranks(df: DataFrame, position: str) -> DataFrame:
    """``(position, _rank)`` for the distinct positions of ``df``."""
    ones = df.select(position).distinct().withColumn("_one", F.lit(1).cast("bigint"))
    ranked = with_prefix_sums(ones, position, ["_one"])
    return ranked.select(position, (F.col("_one_before") + 1).cast("bigint").alias("_rank"))


def with_running_sums(values: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Add ``<c>_upto``, the sum of ``c`` over the rows of the same keys up to the own ``value``.

    ``values`` has one row per keys and value. It is sorted by range partitioning, summed inside the
    partitions and then over the list of partitions, so the values of one key may fill many tasks.
    """
    ordered = values.repartitionByRange(*keys, "value").withColumn("_part", F.spark_partition_id())
    ordered = materialize(ordered, "sorted")
    part = ["_part", *keys]
    up_to = Window.partitionBy(*part).orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ordered.groupBy(*part).agg(*[F.sum(c).alias(c) for c in columns])
    offsets = totals.select(
        *part, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_off_{c}") for c in columns]
    )
    out = ordered.withColumns({f"_in_{c}": F.sum(c).over(up_to) for c in columns}).join(offsets, part)
    out = out.withColumns({f"{c}_upto": F.col(f"_in_{c}") + F.col(f"_off_{c}") for c in columns})
    return out.drop("_part", *[f"_in_{c}" for c in columns], *[f"_off_{c}" for c in columns])


# --- slices of a value range ---------------------------------------------------------------------


@dataclass(frozen=True)
class Slices:
    """Ascending cut points per column. Slice numbers grow with the value, equal values share one."""

    cuts: dict[str, list[float]]

    def add_to(self, df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, Column]]:
        """``df`` with slice columns where a column has cuts, and the slice expression of each column."""
        expressions = {c: F.lit(0) for c in columns}
        cut = [c for c in columns if self.cuts.get(c)]
        if not cut:
            return df, expressions
        outputs = [f"_slice_{i}" for i in range(len(cut))]
        plain = [f"_sliced_{i}" for i in range(len(cut))]
        wide = df.select("*", *[named(c).alias(p) for c, p in zip(cut, plain)])
        ends = (float("-inf"),), (float("inf"),)
        bucketizer = Bucketizer(
            splitsArray=[[*ends[0], *self.cuts[c], *ends[1]] for c in cut],
            inputCols=plain,
            outputCols=outputs,
            handleInvalid="keep",
        )
        for c, o in zip(cut, outputs):
            expressions[c] = F.col(o).cast("int")
        return bucketizer.transform(wide).drop(*plain), expressions


def slices_for(
    df: DataFrame, columns: list[str], rows: int, rows_per_slice: int = ROWS_PER_SLICE
) -> Slices:
    """Cut points that split every column into slices of about ``rows_per_slice`` rows.

    There are at most ``SLICES`` of them; what is inside a slice may fill many tasks. Cuts are quantiles
    of a sample, found by a bounded sketch per column. They need not be exact, because every use counts
    the rows per slice; as in a range partitioner they decide the balance and nothing else.
    """
    parts = min(SLICES, -(-rows // rows_per_slice))
    if parts <= 1:
        return Slices({})
    probabilities = [i / parts for i in range(1, parts)]
    plain = [f"_c{i}" for i in range(len(columns))]
    narrow = df.select(*[named(c).cast("double").alias(p) for c, p in zip(columns, plain)])
    share = SAMPLED_PER_SLICE * parts / rows
    if share < 1:
        narrow = narrow.sample(share, seed=42)
    found = narrow.approxQuantile(plain, probabilities, 1 / (4 * parts))
    return Slices({c: sorted(set(cuts)) for c, cuts in zip(columns, found)})


def long_form(df: DataFrame, columns: list[str], slices: Slices, *keep: Column) -> DataFrame:
    """One row ``(keep..., feature, slice, value)`` per non-null number."""
    sliced, expressions = slices.add_to(df, columns)
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            expressions[c].alias("slice"),
            named(c).cast("double").alias("value"),
        )
        for c in columns
    ]
    # one cell type for all features: a slice literal is never null, a slice column may be
    out = sliced.select(*keep, F.inline(F.array(*cells)))
    return out.filter(F.col("value").isNotNull() & ~F.isnan("value"))


# --- exact quantiles -----------------------------------------------------------------------------


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    by: str | None = None,
    rows: int | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Linearly interpolated quantiles as ``([by,] feature, n, low, high, q0, q1, ...)``.

    Rows are counted per slice of the value range, the counts say which slice holds each wanted rank,
    and only the values of those slices are shuffled and ranked. ``df`` is read three times, so it
    should be a stored table.
    """
    rows = df.count() if rows is None else rows
    keys = ([by] if by else []) + ["feature"]
    slices = slices_for(df, columns, rows, rows_per_slice)
    cells = long_form(df, columns, slices, *([F.col(by)] if by else []))
    counts = cells.groupBy(*keys, "slice").agg(
        F.count(F.lit(1)).alias("_n"), F.min("value").alias("_low"), F.max("value").alias("_high")
    )
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ranks = []
    for i, p in enumerate(probabilities):
        place = (F.col("n") - 1) * F.lit(float(p))
        ranks += [
            F.struct(F.lit(2 * i).alias("which"), F.floor(place).alias("rank")),
            F.struct(F.lit(2 * i + 1).alias("which"), F.ceil(place).alias("rank")),
        ]
    placed = counts.select(
        *keys,
        "slice",
        "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("n"),
        F.min("_low").over(whole).alias("low"),
        F.max("_high").over(whole).alias("high"),
    )
    targets = (
        placed.select("*", F.inline(F.array(*ranks)))
        .filter("rank >= _before AND rank < _before + _n")
        .select(
            *keys, "slice", "n", "low", "high", "which", (F.col("rank") - F.col("_before")).alias("_at")
        )
    )
    # a few rows per group and column: stored, so that their size is known when they are joined
    targets = materialize(targets, "targets")
    wanted = targets.select(*keys, "slice").distinct()
    values = (
        cells.join(wanted, [*keys, "slice"])
        .groupBy(*keys, "slice", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = with_running_sums(values, [*keys, "slice"], ["_n"])
    picked = ranked.join(targets, [*keys, "slice"]).filter("_at < _n_upto AND _at >= _n_upto - _n")
    ends = [
        F.max(F.when(F.col("which") == w, F.col("value"))).alias(f"_v{w}")
        for w in range(2 * len(probabilities))
    ]
    grouped = picked.groupBy(*keys, "n", "low", "high").agg(*ends)
    quantiles = []
    for i, p in enumerate(probabilities):
        place = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        quantiles.append((low + (high - low) * (place - F.floor(place))).alias(f"q{i}"))
    return grouped.select(*keys, "n", "low", "high", *quantiles)


def smallest_per_group(df: DataFrame, group: str, key: Column, n: int, *tie_break: str) -> DataFrame:
    """The ``n`` rows of every group with the smallest ``key``, a well-mixed 64-bit hash.

    Rows are counted per group and hash range. Whole ranges below the cut are kept as they are and
    only the range that holds the cut is ranked, so a hot group is never sorted in one task.
    """
    hashed = df.select("*", key.alias("_hash"))
    hashed = hashed.withColumn("_range", F.shiftright("_hash", 48))
    counts = hashed.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .filter(F.col("_before") < n)
        .groupBy(group)
        .agg(F.max("_range").alias("_cut"), F.max("_before").alias("_full"))
    )
    marked = hashed.join(cut, group).filter(F.col("_range") <= F.col("_cut"))
    within = Window.partitionBy(group, "_range").orderBy("_hash", *tie_break)
    return (
        marked.withColumn("_place", F.row_number().over(within))
        .filter((F.col("_range") < F.col("_cut")) | (F.col("_place") <= F.lit(n) - F.col("_full")))
        .drop("_hash", "_range", "_cut", "_full", "_place")
    )


__all__ = [
    "Slices",
    "dense_ranks",
    "exact_quantiles",
    "join_sized",
    "long_form",
    "slices_for",
    "smallest_per_group",
    "with_prefix_sums",
    "with_row_index",
    "with_running_sums",
    "with_scan_order",
]

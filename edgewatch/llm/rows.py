"""Small helpers the operators share: Arrow batches in pieces of bounded size, column choice."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES``, unless the session asks for smaller ones.

    The default lets a batch grow to 64 MB, which a task holds several times while it works on it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", spark.conf.get(name))) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col(f"`{name.replace('`', '``')}`")


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; other columns cannot clash."""
    return docs.select(
        column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).alias("text")
    )


def with_carried(df: DataFrame, names: list[str] | tuple[str, ...], **own: Column) -> DataFrame:
    """The columns ``own`` and a struct ``carried`` of the columns in ``names``, which passes through."""
    filler = "row"  # a struct needs a field
    while filler.lower() in {n.lower() for n in names}:
        filler += "_"
    kept = F.struct(*(column(df, n) for n in names), F.lit(True).alias(filler))
    return df.select(*(c.alias(n) for n, c in own.items()), kept.alias("carried"))


def pieces(
    batches: Iterator[pa.RecordBatch], by: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose column ``by`` holds about ``limit`` bytes; a longer row stands alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(by)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            taken = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, taken + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def strings(values: pa.Array) -> list[str]:
    """Texts as Python strings, null as the empty one."""
    return [x or "" for x in values.to_pylist()]


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", limit: int = 1_000_000) -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids`` (a written table of one column); null ids stay.

    The ids go to every task if they are at most ``limit``; more are joined by a shuffle.
    """
    gone = "gone"
    while gone.lower() in {c.lower() for c in docs.columns}:
        gone += "_"
    ids = ids.toDF(gone)
    ids = F.broadcast(ids) if ids.count() <= limit else ids
    return docs.join(ids, column(docs, id_col) == F.col(gone), "left_anti")


def text_digest(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def without_texts(
    docs: DataFrame, rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 1_000_000
) -> DataFrame:
    """Rows of ``docs`` whose id and text are not in ``rows`` (a written table ``doc_id, digest``); a null id is one like others."""
    gone = "gone"
    while any(c.lower().startswith(gone) for c in docs.columns):
        gone += "_"
    rows = rows.toDF(f"{gone}1", f"{gone}2")
    rows = F.broadcast(rows) if rows.count() <= limit else rows
    same = column(docs, id_col).eqNullSafe(F.col(f"{gone}1")) & (text_digest(column(docs, text_col)) == F.col(f"{gone}2"))
    return docs.join(rows, same, "left_anti")

"""The one sequential step of scoring: carrying decayed counters from tick to tick.

A counter entering tick ``r`` is ``D^(r - r')`` of what it was when its entity was last seen, at tick
``r'``, where ``D(c) = floor(alpha * c)``. Rounding makes this non-associative, so each entity is
walked in order. The rows are counts per entity and tick, not events, and a batch of rows is walked
for all its entities at once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TABLE_SIZE = 1 << 16
SCALAR_BELOW = 48  # entities left in a batch; fewer than this are walked one by one


class Decay:
    """``D`` applied ``gap`` times, for whole arrays. ``floor=False`` gives the unrounded power."""

    def __init__(self, alpha: float, floor: bool = True) -> None:
        self.alpha = alpha
        self.floor = floor
        self.dtype = np.int64 if floor else np.float64
        if floor:
            once = np.floor(np.arange(TABLE_SIZE) * alpha).astype(np.int64)
            self.tables = [once]  # tables[j] applies D 2**j times
            for _ in range(TABLE_SIZE.bit_length() - 1):
                self.tables.append(self.tables[-1][self.tables[-1]])

    def __call__(self, count: np.ndarray, gap: np.ndarray) -> np.ndarray:
        if not self.floor:
            return count * np.power(self.alpha, gap)
        count, gap = count.copy(), gap.copy()
        large = np.flatnonzero((count >= TABLE_SIZE) & (gap > 0))
        while large.size:
            count[large] = np.floor(count[large] * self.alpha).astype(np.int64)
            gap[large] -= 1
            large = large[(count[large] >= TABLE_SIZE) & (gap[large] > 0)]
        # a count below the table size is gone after that many steps at most
        gap = np.minimum(gap, TABLE_SIZE)
        for j in range(int(gap.max(initial=0)).bit_length()):
            hit = np.flatnonzero((gap >> j) & 1)
            if hit.size:
                count[hit] = self.tables[j][count[hit]]
        return count

    def one(self, count: float, gap: int) -> float:
        """The same for one counter."""
        if not self.floor:
            return count * self.alpha**gap
        while gap > 0 and count > 0:
            if gap > 32 and count < TABLE_SIZE:
                for j, table in enumerate(self.tables):
                    if min(gap, TABLE_SIZE) >> j & 1:
                        count = int(table[count])
                return count
            count = math.floor(count * self.alpha)
            gap -= 1
        return count


def _changes(column: pa.Array) -> np.ndarray:
    """True where a value differs from the one before it; nulls equal each other."""
    left, right = column.slice(0, len(column) - 1), column.slice(1)
    differs = pc.fill_null(pc.not_equal(left, right), False)
    null_flip = pc.not_equal(pc.is_null(left), pc.is_null(right))
    return pc.or_(differs, null_flip).to_numpy(zero_copy_only=False)


def _walk(
    starts: np.ndarray,
    lengths: np.ndarray,
    rank: np.ndarray,
    added: np.ndarray,
    carried: np.ndarray,
    carried_rank: np.ndarray,
    decay: Decay,
) -> np.ndarray:
    """Counter before each row. ``carried`` is the counter of each group after its previous row."""
    before = np.zeros(len(rank), dtype=decay.dtype)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    value, last = carried[order].astype(decay.dtype), carried_rank[order].copy()
    step, alive = 0, len(starts)
    while alive > SCALAR_BELOW or (alive and step == 0):
        at = starts[:alive] + step
        before[at] = decay(value[:alive], rank[at] - last[:alive])
        value[:alive] = before[at] + added[at]
        last[:alive] = rank[at]
        step += 1
        alive = int(np.searchsorted(-lengths, -step, side="left"))
    for g in range(alive):
        rows = slice(int(starts[g]) + step, int(starts[g] + lengths[g]))
        v, r, walked = value[g].item(), int(last[g]), []
        for next_rank, add in zip(rank[rows].tolist(), added[rows].tolist()):
            v = decay.one(v, next_rank - r)
            walked.append(v)
            v, r = v + add, next_rank
        before[rows] = walked
    return before


def fold_batches(
    keys: list[str], alpha: float, floor: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``cur0`` and ``tot0`` to batches sorted by ``keys`` and rank, across batch borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decay = Decay(alpha, floor)
        last_key, last_rank, last_cur, last_tot = None, 0, decay.dtype(0), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(k) for k in keys]
            first_key = tuple(c[0].as_py() for c in columns)
            new = np.zeros(n, dtype=bool)
            new[0] = True
            for column in columns:
                new[1:] |= _changes(column)
            starts = np.flatnonzero(new)
            lengths = np.diff(np.append(starts, n))
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            n_cur = batch.column("n_cur").to_numpy(zero_copy_only=False).astype(decay.dtype)
            n_tot = batch.column("n_tot").to_numpy(zero_copy_only=False)

            carried = np.zeros(len(starts), dtype=decay.dtype)
            carried_rank = rank[starts].copy()
            offset = np.zeros(len(starts), dtype=np.int64)
            if first_key == last_key:
                carried[0], carried_rank[0], offset[0] = last_cur, last_rank, last_tot

            running = np.cumsum(n_tot) - n_tot
            tot0 = running - np.repeat(running[starts] - offset, lengths)
            cur0 = _walk(starts, lengths, rank, n_cur, carried, carried_rank, decay)

            last_key = tuple(c[n - 1].as_py() for c in columns)
            last_rank, last_cur, last_tot = rank[-1], cur0[-1] + n_cur[-1], tot0[-1] + n_tot[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cur0), pa.array(tot0)],
                names=[*batch.schema.names, "cur0", "tot0"],
            )

    return run


def fold_counts(counts: DataFrame, keys: list[str], alpha: float, floor: bool = True) -> DataFrame:
    """``counts(keys..., _rank, _slice, n_cur, n_tot)`` plus the counters before each row.

    ``cur0`` is decayed and ``tot0`` is not. An entity has one row per tick it was seen in (a few if
    the tick is sliced), so even the hottest one is bounded by the length of the stream in ticks.
    """
    counter = T.LongType() if floor else T.DoubleType()
    schema = T.StructType(
        [*counts.schema.fields, T.StructField("cur0", counter), T.StructField("tot0", T.LongType())]
    )
    ordered = counts.repartition(*keys).sortWithinPartitions(*keys, "_rank", "_slice")
    return ordered.mapInArrow(fold_batches(keys, alpha, floor), schema)

"""Counters of events that share Count-Min cells, for whole (tick, slice) groups at once.

Rows come sorted by group, the cells' counters at the start of the group first and its events after them
in stream order. An event's counter in a hash row is its cell's start plus the events of the same cell up
to it; the estimate of a kind is the least over its hash rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_ROWS = 50_000


def _running(cells: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each event, events and kept events of its cell up to and with itself."""
    order = np.argsort(cells, kind="stable")
    ordered = cells[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    sums = np.cumsum(kept[order])
    n, k = np.empty((2, len(order)), np.int64)
    n[order] = np.arange(len(order)) - start + 1
    k[order] = sums - sums[start] + kept[order][start]
    return n, k


def _groups(table: pa.Table) -> np.ndarray:
    """Ascending group number of each row."""
    at, piece = (table[c].to_numpy() for c in ("_at", "_slice"))
    return np.cumsum(np.concatenate(([False], (at[1:] != at[:-1]) | (piece[1:] != piece[:-1]))))


def place_batches(
    columns: list[str], kinds: tuple[str, ...], depth: int, width: int, floor: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Events of sorted batches with ``<kind>_current`` and ``<kind>_total``, across batch borders."""
    n_cells = len(kinds) * depth * width
    counter = np.int64 if floor else np.float64

    def place(table: pa.Table) -> Iterator[pa.RecordBatch]:
        group = _groups(table)
        is_event = table["_mark"].to_numpy() == 1
        events = table.filter(pa.array(is_event))
        starts = table.filter(pa.array(~is_event))
        if not events.num_rows:
            return
        keys = group[~is_event] * n_cells + starts["_cell"].to_numpy()
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        cur0, tot0 = starts["cur0"].to_numpy()[order], starts["tot0"].to_numpy()[order]
        ids = events["_cells"].combine_chunks().flatten().to_numpy().reshape(events.num_rows, -1)
        kept = events["_keep"].to_numpy(zero_copy_only=False).astype(np.int64)
        own = group[is_event] * n_cells
        out = []
        for kind in range(len(kinds)):
            best = None
            for row in range(kind * depth, (kind + 1) * depth):
                cell = np.searchsorted(keys, own + ids[:, row])
                n, k = _running(cell, kept)
                # the event itself always counts, whether or not later events will see it
                both = cur0[cell].astype(counter) + n, tot0[cell] + k + (1 - kept)
                best = both if best is None else tuple(map(np.minimum, best, both))
            out += [pa.array(x) for x in best]
        names = [f"{kind}_{c}" for kind in kinds for c in ("current", "total")]
        placed = events.select(columns)
        for name, values in zip(names, out, strict=True):
            placed = placed.append_column(name, values)
        yield from placed.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < CHUNK_ROWS:
                continue
            table = pa.Table.from_batches(held)
            group = _groups(table)
            whole = int(np.searchsorted(group, group[-1]))
            if whole:  # the last group may go on
                yield from place(table.slice(0, whole))
            held, rows = table.slice(whole).to_batches(), 0
        if held and (table := pa.Table.from_batches(held)).num_rows:
            yield from place(table)

    return run

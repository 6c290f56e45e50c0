import math

import numpy as np
import pyarrow as pa
import pytest

from edgewatch.operators.decay_fold import Decay, fold_batches


def repeated(count, gap, alpha):
    for _ in range(gap):
        count = math.floor(count * alpha)
    return count


@pytest.mark.parametrize("alpha", [0.0, 0.3, 0.5, 0.98, 0.999])
def test_decay_equals_repeated_rounding(alpha):
    rng = np.random.default_rng(1)
    counts = np.concatenate([rng.integers(0, 200, 300), rng.integers(0, 3_000_000, 60)])
    gaps = np.concatenate([rng.integers(0, 60, 300), rng.integers(0, 700, 60)])
    decay = Decay(alpha)
    expected = [repeated(int(c), int(g), alpha) for c, g in zip(counts, gaps)]
    assert decay(counts, gaps).tolist() == expected
    assert [decay.one(int(c), int(g)) for c, g in zip(counts, gaps)] == expected


def test_decay_known_values():
    decay = Decay(0.98)
    assert decay(np.array([1, 50, 100]), np.array([1, 1, 1])).tolist() == [0, 49, 98]


def test_real_valued_decay():
    decay = Decay(0.5, floor=False)
    assert decay(np.array([3.0]), np.array([2])).tolist() == [0.75]
    assert decay.one(3.0, 2) == 0.75


@pytest.mark.parametrize("batch_rows", [1, 7, 1000])
def test_fold_across_batches(batch_rows):
    rng = np.random.default_rng(2)
    rows = []
    for key in [f"k{i:03d}" for i in range(120)]:
        for rank in sorted(rng.choice(500, size=rng.integers(1, 40), replace=False).tolist()):
            n = int(rng.integers(1, 50))
            rows.append((key, rank, n, n // 2))
    table = pa.table(
        {
            "key": pa.array([r[0] for r in rows]),
            "_rank": pa.array([r[1] for r in rows], pa.int64()),
            "n_cur": pa.array([r[2] for r in rows], pa.int64()),
            "n_tot": pa.array([r[3] for r in rows], pa.int64()),
        }
    )
    out = pa.Table.from_batches(
        fold_batches(["key"], 0.9, True)(iter(table.to_batches(max_chunksize=batch_rows)))
    ).to_pydict()
    state = {}
    for i, (key, rank, n, kept) in enumerate(rows):
        cur, tot, last = state.get(key, (0, 0, rank))
        cur = repeated(cur, rank - last, 0.9)
        assert (out["cur0"][i], out["tot0"][i]) == (cur, tot)
        state[key] = (cur + n, tot + kept, rank)

import random
from collections import defaultdict

import numpy as np
import pytest

from edgewatch.llm import line_dedup, perfect_hash

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _model(rows, min_chars=20, min_docs=3):
    holders = defaultdict(list)
    for number, (doc_id, text) in enumerate(rows):
        for key in {x.strip(" \t\n\x0b\x0c\r").translate(LOW) for x in (text or "").split("\n")}:
            if len(key) >= min_chars:
                holders[key].append((number, doc_id))
    out = []
    for doc_id, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            held = holders.get(line.strip(" \t\n\x0b\x0c\r").translate(LOW), [])
            ids = [i for _, i in held if i is not None]
            if len(held) >= min_docs and ids and max(ids) != doc_id:
                continue
            kept.append(line)
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def _rows(n=300):
    rng = random.Random(5)
    lines = [f"A shared line with number {i} and é" for i in range(40)]
    lines += ["kurz", "", "x" * 19, "y" * 20, "é" * 19, "é" * 20, "  \t padded common line of text \r", "PADDED common line of TEXT"]
    rows = []
    for i in range(n):
        own = [f"only document {i} holds line {j}" for j in range(rng.randrange(3))]
        rows.append((i * 7 % n, "\n".join(rng.sample(lines, rng.randrange(8)) + own)))
    rows += [(n + 1, None), (n + 2, ""), (n + 3, "z" * 40 + "\n" + "z" * 40), (5, rows[0][1]), (None, rows[1][1])]
    return rows + [(n + 9, "long " * 50_000 + "\n" + lines[0])]


@pytest.mark.parametrize("bound", [line_dedup.BROADCAST_BYTES, 0])
def test_equals_model_in_both_ways(spark, monkeypatch, bound):
    monkeypatch.setattr(line_dedup, "GROUP_PROBES", 50)
    rows = _rows()
    docs = spark.createDataFrame([(t, i, "c") for i, t in rows], "text string, doc_id long, place string")
    out = line_dedup.drop_repeated_lines(
        docs.repartition(3), carry=("place",), broadcast_bytes=bound, shard_lines=9
    )
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str)
    assert got == _model(rows)
    assert out.filter("carried.place = 'c'").count() == len(rows)


@pytest.mark.parametrize("bound", [line_dedup.BROADCAST_BYTES, 0])
def test_empty_table(spark, bound):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_repeated_lines(docs, broadcast_bytes=bound).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, (2, 20_000)).astype(np.uint64)
    keys[0, :50] = 7  # equal in the first half only
    sizes, bits = perfect_hash.build(*keys)
    assert sorted(perfect_hash.slots(sizes, bits, *keys)) == list(range(20_000))
    empty = perfect_hash.build(keys[0, :0], keys[1, :0])
    assert (perfect_hash.slots(*empty, *keys) == -1).all()

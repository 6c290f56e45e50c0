import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from edgewatch.llm import paragraph_sketch as sketch


def _units(text):
    return Counter(x for x in re.split(r"\n|(?<=[.!?]) ", text) if x)


def _near(a, b):
    a, b = _units(a), _units(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def _texts(n=60):
    rng = random.Random(4)
    lines = [f"Sentence {i} here. And é another one! So? yes" for i in range(25)]
    texts = ["\n".join(rng.choices(lines, k=rng.randrange(12))) for _ in range(n)]
    return [*texts, "", None, ".", "a", "\n\n", "same. " * 2000, texts[3], " ".join(lines) * 8]


def test_likeness_and_differences_are_exact():
    texts = [t or "" for t in _texts()]
    paragraphs = sketch.Paragraphs([t.encode() for t in texts])
    old, new = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    want = [_near(texts[i], texts[j]) for i, j in zip(old, new, strict=True)]
    assert np.allclose(sketch.likeness(paragraphs, old, new), want)
    prints = sketch.fingerprints(paragraphs)
    assert all((prints[i] == prints[j]) >= (texts[i] == texts[j]) for i, j in zip(old, new, strict=True))
    assert len(set(prints)) == len({frozenset(_units(t).items()) for t in texts})


def _model(rows):
    # the order of equal ids is that of a hash, so the rows here have either distinct ids or equal texts
    order = sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0], reverse=True)
    out = []
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((str(doc), len(text), digest, round(_near(text, edited), 9), round(_near(text, after), 9)))
    return sorted(out)


@pytest.mark.parametrize("rows", [80, 1, 2])
def test_edits_follow_descending_ids(spark, rows):
    texts = _texts()
    ids = random.Random(1).sample(range(-50, 10_000), len(texts))
    data = [*zip(ids, texts, strict=True), (None, "of null."), (ids[3], texts[3])][-rows:]
    docs = spark.createDataFrame([(t, i, 1) for i, t in data], "text string, doc_id long, bucket int")
    got = sketch.fingerprint_edits(docs.repartition(3)).collect()
    found = sorted(
        (str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got
    )
    assert found == _model(data)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sketch.fingerprint_edits(docs).count() == 0


def test_versions_give_the_digests_that_differ(spark):
    rows = [(1, "one.\ntwo.\nthree.", "one.\n2.\nthree."), (2, None, ""), (3, "", "new. text."), (4, "x\nx", "x")]
    frame = spark.createDataFrame(rows, "id long, old string, new string")
    got = {r.id: r for r in sketch.compare_versions(frame, "id", "old", "new").collect()}
    assert [(len(got[i].removed), len(got[i].added)) for i in (1, 2, 3, 4)] == [(1, 1), (0, 0), (0, 2), (1, 0)]
    assert got[2].old_fingerprint == got[2].new_fingerprint and got[2].likeness == 1
    assert got[1].likeness == 0.5 and got[4].likeness == 0.5

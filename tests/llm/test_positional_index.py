import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from edgewatch.llm import positional_index, word_hash

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def _model(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        w = _words(text)
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            windows[tuple(w[i : i + size])].add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = _words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i : i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def _case():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "naïve", "of", "THE", "7"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.randrange(1, 40))) for i in range(30)]
    items += [(90, items[0][1]), (91, None), (92, "  ,, "), (None, "null item of four"), (93, "one")]
    docs = []
    for i in range(120):
        parts = [text(rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            w = items[rng.randrange(30)][1].split()
            parts.append("; ".join(w[rng.randrange(3) :]).upper())
            parts.append(text(rng.randrange(12)))
        docs.append((i, " ".join(parts)))
    docs += [(200, None), (201, ""), (202, "?! --"), (203, items[3][1] * 300), (5, docs[5][1]), (None, docs[6][1])]
    return docs, items


@pytest.mark.parametrize("block", [positional_index.ITEM_BLOCK_BYTES, 900])
def test_equals_model(spark, monkeypatch, block):
    monkeypatch.setattr(word_hash, "GROUP_BYTES", 500)
    docs, items = _case()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, items string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    out = positional_index.contamination(d, b, block_bytes=block).collect()
    got = [(r.doc_id, r.n_words, sum(e - s for s, e in zip(r.starts, r.ends, strict=True)), tuple(r["items"])) for r in out]
    assert sorted(got, key=str) == _model(docs, items)
    assert all(e < s for r in out for e, s in zip(r.ends, r.starts[1:], strict=False))


def test_near_finds_terms_in_any_order(spark):
    docs = spark.createDataFrame(
        [(1, "b x a y c"), (2, "a b q q q q c"), (3, "c b a"), (4, "a c"), (5, "a b")], "doc_id long, text string"
    )
    phrases = positional_index.Phrases([(7, "a b c")], 10)
    items = spark.createDataFrame([(7, "a b c")], "item_id long, text string")
    index = positional_index.build_index(docs.coalesce(1), positional_index.term_filter(items), 10)
    found = positional_index.find_near(index, phrases, 5).collect()
    assert {r.doc_id for r in found} == {1, 3} and all(list(r["items"]) == ["7"] for r in found)


@pytest.mark.parametrize("block", [positional_index.ITEM_BLOCK_BYTES, 20])
def test_rows_of_null_and_repeated_ids_keep_their_own(spark, block):
    """A clean and a contaminated text of the same length, under no id and under one id."""
    dirty, clean = " ".join(f"t{i}" for i in range(12)), " ".join(f"c{i}" for i in range(12))
    docs = [(i, t) for i in (None, 4) for t in (dirty, clean, clean)]
    items = [(1, dirty), (2, "x y"), (3, "p q r"), (4, " ".join(f"t{i}" for i in range(3, 12)))]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    b = spark.createDataFrame(items, "item_id long, text string")
    out = positional_index.contamination(d, b, block_bytes=block).collect()
    got = sorted(((r.doc_id, list(r.starts), list(r.ends), list(r["items"])) for r in out), key=str)
    assert got == sorted(((i, [0], [12], ["1", "4"]) if t is dirty else (i, [], [], []) for i, t in docs), key=str)
    assert len({r.row for r in out}) == len(docs)


def test_filter_keeps_all_test_terms(spark):
    words = [f"w{i}" for i in range(5000)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, None)], "item_id long, text string")
    wanted = positional_index.term_filter(items)
    hashes, _ = word_hash.word_hashes([" ".join(words).encode()])
    others, _ = word_hash.word_hashes([" ".join(f"o{i}" for i in range(5000)).encode()])
    assert positional_index._in_filter(hashes, wanted).all()
    assert positional_index._in_filter(others, wanted).mean() < 0.01


def test_empty_tables(spark):
    docs, items = _case()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert positional_index.contamination(d.limit(0), b).count() == 0
    none = positional_index.contamination(d, b.limit(0))
    assert none.count() == len(docs) and none.filter(F.size("items") > 0).count() == 0


def test_hashes_are_of_whole_words():
    hashes, counts = word_hash.word_hashes([b"Ab ab", b"", b"a b ab\xc3\xa9 aB"])
    assert counts.tolist() == [2, 0, 4]
    assert hashes[0] == hashes[1] == hashes[5]
    assert len(set(hashes.tolist())) == 4

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from edgewatch.llm import ppm_language as ppm
from edgewatch.llm.hash_table import HashTable


def _frame(by_lang):
    rows = []
    for lang, texts in by_lang.items():
        tally = Counter()
        for text in texts:
            raw = ppm.PAD + ppm.plain(text)
            tally.update(raw[i : i + ppm.WIDTH] for i in range(len(raw) - ppm.ORDER))
        rows += [(lang, int.from_bytes(g, "big"), n) for g, n in tally.items()]
    return pd.DataFrame(rows, columns=["lang", "gram", "n"])


def _code_length(texts, text):
    """Byte by byte, from dictionaries of contexts."""
    after = defaultdict(Counter)
    for t in texts:
        raw = ppm.PAD + ppm.plain(t)
        for i in range(ppm.ORDER, len(raw)):
            for k in range(ppm.ORDER + 1):
                after[raw[i - k : i]][raw[i]] += 1
    raw, total = ppm.PAD + ppm.plain(text), 0.0
    for i in range(ppm.ORDER, len(raw)):
        for k in range(ppm.ORDER, -1, -1):
            seen = after.get(raw[i - k : i])
            if not seen:
                continue
            size = sum(seen.values()) + len(seen)
            if raw[i] in seen:
                total -= math.log2(seen[raw[i]] / size)
                break
            total -= math.log2(len(seen) / size)
        else:
            total += 8
    return total


def test_code_lengths_equal_a_byte_by_byte_model():
    by_lang = {"a": ["the cat sat on the mat", "then the end"], "b": ["der hund und die katze", "ünd"], "c": ["xyxyxyx"]}
    model = ppm.Model(_frame(by_lang))
    texts = ["the mat", "Und der Hund", "xyz", "q€w", "then den then", "a", "日本"]
    got = model.bits([ppm.plain(t) for t in texts])
    want = [[_code_length(by_lang[lang], t) for lang in model.langs] for t in texts]
    assert np.allclose(got, want, atol=1e-3)


def _docs(spark, rows):
    return spark.createDataFrame(
        [(*r, 1.0, "x") for r in rows], "doc_id long, text string, lang string, score double, bits_per_byte string"
    )


def test_held_out_accuracy_on_the_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = ppm.identify_language(docs, ppm.train(docs), carry=("lang",))
    rows = found.select("doc_id", "lang", "score", F.col("carried.lang").alias("label")).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(rows) == 1000 and sum(r.lang == r.label for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    train = [(i, f"sample text of letters number {i}", "en") for i in range(40)]
    train += [(100 + i, f"ein satz mit der zahl {i}", "de") for i in range(40)]
    docs = _docs(spark, [*train, (1, None, None), (2, "", "en"), (3, "12 34 !!", "en"), (None, "satz", "de"),
                         (900, "satz mit " * 20_000, None), (900, "satz mit " * 20_000, None), (901, "SAMPLE", None)])
    rows = ppm.identify_language(docs.repartition(2), ppm.train(docs)).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is None or r.doc_id >= 900}
    assert (by_id[900].lang, by_id[None].lang, by_id[901].lang) == ("de", "de", "en")
    assert sum(r.lang == ppm.UNDETERMINED and r.score == 0 for r in rows) == 3


def test_nothing_learned(spark):
    docs = _docs(spark, [(1, "text", None)])
    assert [r.lang for r in ppm.identify_language(docs, ppm.train(docs)).collect()] == ["und"]
    assert ppm.identify_language(docs.limit(0), ppm.train(docs.limit(0))).count() == 0


def test_hash_table_finds_all_keys():
    keys = np.unique(np.random.default_rng(2).integers(0, 2**63, 5000).astype(np.uint64))
    table = HashTable(keys, np.arange(len(keys), dtype=np.int32), np.int32(-1))
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1)) == np.where(np.isin(keys + np.uint64(1), keys), 0, -1)).all()
    assert len(HashTable(keys[:0], np.empty(0, np.int32), np.int32(-1)).find(keys)) == len(keys)

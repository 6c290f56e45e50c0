"""Weights against plain sums, and draws against a plain sort."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgewatch.llm import importance_planes as planes


def test_planes_give_exact_sums():
    rng = np.random.default_rng(1)
    for n in (1, 63, 64, 65, 1000):
        gains = rng.integers(-20_000, 20_000, n)
        counts = rng.integers(0, 5_000, (7, n)) * (rng.random((7, n)) < 0.2)
        assert planes.SignedPlanes(gains).weights(counts).tolist() == (counts @ gains).tolist()
    assert planes.SignedPlanes(np.zeros(5, np.int64)).weights(np.zeros((2, 5), np.int64)).tolist() == [0, 0]


def plain(rows, target, most_words, buckets, percent, least_words, seed):
    def features(text):
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = "".join(c if not c.isascii() or c.isalnum() else " " for c in lowered).split(" ")
        words = [w for w in words if w]
        return words, [" ".join(words[i : i + n]) for n in range(1, most_words + 1) for i in range(len(words) - n + 1)]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    corpus = Counter(bucket(f) for _, text in rows for f in features(text)[1])
    wanted = Counter(bucket(f) for text in target for f in features(text)[1])
    s, t = corpus.total(), wanted.total()
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((corpus[b] + 1) * (t + buckets))))
        for b in range(buckets)
    ]
    out = []
    for doc_id, text in rows:
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words), len(found), weight, score, None])
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out))


@pytest.mark.parametrize("most_words", [1, 2, 3])
def test_against_plain_sums(spark, most_words):
    rnd = random.Random(most_words)
    vocabulary = [f"word{i}" for i in range(300)] + ["Übung", "a-b", "X9", "…"]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 60)))) for i in range(400)]
    target = [" ".join(rnd.choices(vocabulary[:40], k=30)) for _ in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    found = planes.resample(docs, items, 10, 20, 500, most_words, 2024)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[:5]) == plain(rows, target, most_words, 500, 10, 20, 2024)


def test_ranks_run_over_slices_and_ties_go_to_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(planes, "ROWS_PER_SLICE", 40)
    rows = spark.range(1000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 3).alias("weight"), (F.col("id") % 7).alias("score"),
        F.lit(True).alias("eligible"), F.col("id").alias("row"),
    )
    got = {r["doc_id"]: r["rank"] for r in planes.ranked(rows, 250).collect()}
    order = sorted(range(1000), key=lambda i: (-(i % 7), i))
    assert got == {i: (place if place <= 250 else None) for place, i in enumerate(order, 1)}


def test_rows_of_every_kind(spark):
    text = "alpha beta " * 15
    rows = [(1, None, 5), (2, "", 5), (None, text, 5), (3, text, None), (3, text, None), (4, "!!", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    none = spark.createDataFrame([], "text string")
    found = planes.resample(docs, none, percent=100).collect()
    assert sorted(r["n_features"] for r in found) == [0, 0, 0, 30, 30, 30]
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3]
    assert all(r["weight"] == 0 for r in found if not r["n_features"])
    assert planes.resample(docs.limit(0), none).count() == 0


def test_memo_forgets_without_changing_results(monkeypatch):
    monkeypatch.setattr(planes, "MEMO_WORDS", 3)
    buckets = planes.Buckets(97)
    for i in range(50):
        word = b"w%d" % (i % 9)
        assert buckets[word] == zlib.crc32(word) % 97
    assert len(buckets) <= 3

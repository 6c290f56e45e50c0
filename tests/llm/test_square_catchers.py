"""Runs against a plain search of every period, and the collapsed texts."""

import random

import numpy as np
import pytest

from edgewatch.llm.square_catchers import (
    Catchers,
    Run,
    collapse_runs,
    find_runs,
    kept_words,
    with_period,
    word_values,
)


def plain_runs(words, least):
    """All maximal stretches by trying each period at each place."""
    smallest = {}
    for p in range(1, len(words) // 3 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, 3 * p):
                smallest.setdefault((i, j - i + p), p)
            i = j if j > i else i + 1
    return sorted(((s, n, p) for (s, n), p in smallest.items()), key=lambda r: (r[0], r[2]))


def repetitive_texts(n, seed):
    rnd = random.Random(seed)
    for _ in range(n):
        words = []
        for _ in range(rnd.randint(0, 6)):
            unit = [rnd.choice("abc"[: rnd.randint(1, 3)]) for _ in range(rnd.randint(1, 9))]
            words += (unit * rnd.randint(1, 9))[: rnd.randint(1, 70)]
            words += [rnd.choice("abcdef") for _ in range(rnd.randint(0, 12))] if rnd.random() < 0.5 else []
        yield " ".join(words).encode()


@pytest.mark.parametrize("least", [3, 24])
def test_all_runs_are_found(least):
    texts = list(repetitive_texts(600, 5))
    for text, found in zip(texts, find_runs(texts, least), strict=True):
        assert [tuple(r) for r in found] == plain_runs(text.split(), least)


def test_words_may_come_in_pieces_of_any_size():
    rnd = random.Random(6)
    for text in repetitive_texts(150, 7):
        words, _ = word_values([text])
        catchers, at = Catchers(), 0
        while at < len(words):
            piece = words[at : at + rnd.randint(1, 13)]
            catchers.append(piece, np.zeros(len(piece), np.int64))
            at += len(piece)
        assert [tuple(r) for r in catchers.runs()] == plain_runs(text.split(), 3)


def test_a_square_is_reported_before_its_third_period_ends():
    words, _ = word_values([b" ".join(b"%d" % i for i in range(30)) + b" a b c d a b c d a b c d"])
    catchers, reported = Catchers(), {}
    for i in range(len(words)):
        for start, length, period in catchers.append(words[i : i + 1], np.zeros(1, np.int64)).tolist():
            reported.setdefault((start, period), []).append((i, length))
    # the block of words 32 to 35 catches it when word 39 comes; every further word makes it grow
    assert reported == {(30, 4): [(39, 10), (40, 11), (41, 12)]}
    assert catchers.runs().tolist() == [[30, 12, 4]]


def test_very_long_run_costs_little():
    assert find_runs([b"a " * 50_000 + b"b"], 24) == [[Run(0, 50_000, 1)]]


def test_texts_do_not_reach_into_each_other():
    assert find_runs([b"a " * 20, b"a " * 20, b"", b" \n"], 24) == [[], [], [], []]


def test_kept_words_with_overlapping_runs():
    words = [b"%d" % i for i in range(20)]
    runs = [Run(0, 9, 3), Run(7, 9, 2)]
    assert kept_words(words, runs) == [words[i] for i in (0, 1, 2, *range(16, 20))]


def test_rows_of_every_kind(spark):
    long = "w " * 30
    rows = [(1, None, "x"), (2, "", "x"), (None, long, "x"), (3, long, None), (3, long, None), (4, "one two", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = sorted(collapse_runs(docs).collect(), key=lambda r: (r["doc_id"] or 0, r["n_words"]))
    assert [(r["doc_id"], r["n_words"], r["n_kept"], bytes(r["collapsed"])) for r in found] == [
        (None, 30, 1, b"w"), (1, 0, 0, b""), (2, 0, 0, b""), (3, 30, 1, b"w"), (3, 30, 1, b"w"), (4, 2, 2, b"one two"),
    ]
    assert [tuple(x) for x in found[0]["runs"]] == [(0, 30, 1)]
    assert collapse_runs(docs.limit(0)).count() == 0


def test_edit_touches_a_tenth_and_keeps_the_length():
    words = [b"%d" % i for i in range(100)]
    changed = [i for i in range(2_000) if with_period(words, i) != words]
    assert 100 < len(changed) < 300
    assert all(len(with_period(words, i)) == 100 for i in changed)
    assert with_period(words, None) == words and with_period([], changed[0]) == []

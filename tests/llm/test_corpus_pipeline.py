import base64
import hashlib
import random
import re

import public_tokenizers as public
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_line_dedup import _model as without_lines
from tests.llm.test_positional_index import _model as hits
from tests.llm.test_shingle_join import _model as groups


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, copies, near copies, shared lines, benchmark passages, junk."""
    rng = random.Random(6)
    words = [f"{a}{b}{c}" for a in ("lo", "mi", "ka", "ru") for b in ("den", "sal", "tor") for c in ("a", "is", "um")]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, text(rng.randrange(12, 30))) for i in range(8)]
    shared = [text(9) for _ in range(4)]
    rows = []
    for i in range(160):
        body = text(rng.randrange(30, 120))
        if i % 7 == 0:
            body += "\n" + rng.choice(shared)
        if i % 11 == 0:
            body += " " + rng.choice(items)[1] + " " + text(5)
        rows.append((i, body))
    for i in range(30):
        near = rows[i * 3][1].split(" ")
        near[rng.randrange(len(near))] = "changed"
        rows.append((200 + i, " ".join(near) if i % 2 else rows[i * 3][1]))
    rows += [(300, None), (301, ""), (302, "12 34 ?!"), (303, text(4)), (304, "long " + text(20_000))]
    path = str(tmp_path_factory.mktemp("corpus"))
    data = [(i, t, rng.choice(["aa", "bb", None]), "s", len(t or ""), i % 3) for i, t in rows]
    spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, carried int"
    ).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages_are_the_dealt_ones_and_keep_the_columns(spark, corpus):
    path, rows, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert out.filter("carried != doc_id % 3").count() == 0


def test_run_equals_a_plain_version(spark, corpus):
    path, rows, items = corpus
    kept = [(i, t) for i, t in rows if t and re.search(r"[^\W\d_]", t)]
    kept = [(i, t) for i, t, _, _ in without_lines(kept)]
    kept = [(i, t) for i, t in kept if next(c for d, _, c in groups_of(kept) if d == i) == i]
    clean = {i for i, _, n_hit, _ in hits(kept, items) if not n_hit}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in kept:
        if i in clean:
            ids = library.encode_ordinary(t)
            raw = b"".join(x.to_bytes(4, "little") for x in ids)
            want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = sorted(map(tuple, corpus_pipeline.run(spark, path).collect()))
    assert 60 < len(want) < len(rows) - 30
    assert got == sorted(want)


_SEEN = {}


def groups_of(rows):
    key = len(rows)
    if key not in _SEEN:
        _SEEN[key] = groups(rows, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILARITY_PERCENT)
    return _SEEN[key]


def test_empty_tables(spark, tmp_path):
    path = f"file://{tmp_path}"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet"
    )
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_without_labels_all_texts_with_letters_stay(spark):
    rows = [(1, "some words", None), (2, "12 34 ?!", None), (3, None, None), (4, "Übung", None), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language(spark, docs, "")
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 4, None]


def test_a_clean_text_stays_beside_a_contaminated_one_of_its_id(spark, tmp_path):
    dirty = " ".join(f"t{i}" for i in range(12))
    spark.createDataFrame([(1, dirty)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, t) for i in (None, 4) for t in (dirty, "a clean text", "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gone1", F.lit(1))
    kept = corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted((r for r in rows if r[1] != dirty), key=str)


def test_no_task_of_the_encoding_takes_two_workers(spark):
    """Workers stay with the executor, each with a vocabulary and a memo."""
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    plan = corpus_pipeline.encode(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1

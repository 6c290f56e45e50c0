import base64
import hashlib

import public_tokenizers as public
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edgewatch.llm import bpe_matrix, token_counts

RANKS = public.path("byte_bpe_50k.tiktoken")
SPEC = public.path("byte_bpe_50k.json")
TEXTS = [
    None,
    "",
    " ",
    "\n\n  \t x",
    "it's I'll we've  don't",
    "naïve café – œuvre 東京都 😀😀 \u0085 　x",
    "a" * 3000,
    "ab" * 700 + " " * 500 + "9" * 400,
    "x<|endoftext|>y <|endoftext|><|endoftext|>",
    "password=e3b3ed3cc8548923d6 $$$ ### €€",
    "\x1c\x1d\x00\x7f",
    "the quick brown fox " * 2000,
    "qzxj" * 90,
]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _docs(spark, texts):
    rows = [(i, t, "kept", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, `n_tokens` string")


def test_encode_and_decode_equal_the_library(spark, library):
    encoded = bpe_matrix.encode_texts(_docs(spark, TEXTS + TEXTS[:5]), RANKS, public.PATTERN)
    rows = bpe_matrix.decode_ids(encoded, RANKS, public.PATTERN).collect()
    assert len(rows) == len(TEXTS) + 5
    for row in rows:
        text = (TEXTS + TEXTS[:5])[row.doc_id] or ""
        want = b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(text))
        assert bytes(row.ids) == want, text[:40]
        assert bytes(row.bytes) == text.encode()


def test_corpus_rows_equal_the_libraries(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in bpe_matrix.encode_texts(docs, RANKS, public.PATTERN).collect():
        want = library.encode_ordinary(texts[row.doc_id])
        assert hashlib.sha256(row.ids).digest() == hashlib.sha256(
            b"".join(i.to_bytes(4, "little") for i in want)
        ).digest()
    other = Tokenizer.from_file(SPEC)
    for row in token_counts.count_tokens(docs, SPEC, public.PATTERN).collect():
        assert row.n_tokens == len(other.encode(texts[row.doc_id], add_special_tokens=False).ids)
        assert row.n_bytes == len(texts[row.doc_id].encode())


def test_counts_equal_the_library(spark):
    other = Tokenizer.from_file(SPEC)
    for row in token_counts.count_tokens(_docs(spark, TEXTS), SPEC, public.PATTERN).collect():
        want = other.encode(TEXTS[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(want), (TEXTS[row.doc_id] or "")[:40]


def test_full_memo_is_only_a_memo(monkeypatch):
    content = bpe_matrix.read_vocabulary(RANKS)
    own = bpe_matrix.Encoder(content, public.PATTERN)
    before = list(own.encode_batch(["some words here"]))
    monkeypatch.setattr(bpe_matrix, "MEMO_WORDS", 0)
    assert list(own.encode_batch(["some words here"])) == before
    counts = token_counts.Counter(bpe_matrix.read_vocabulary(SPEC), public.PATTERN)
    n = counts.count_text("some words here")
    monkeypatch.setattr(token_counts, "MEMO_WORDS", 0)
    assert counts.count_text("some other words here") >= n


def test_empty_table_and_null_id(spark):
    docs = _docs(spark, ["x"])
    assert bpe_matrix.encode_texts(docs.limit(0), RANKS, public.PATTERN).count() == 0
    nulls = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert [tuple(r) for r in token_counts.count_tokens(nulls, SPEC, public.PATTERN).collect()] == [(None, 1, 1)]


def test_one_pass_gives_the_rows_of_two(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    two = bpe_matrix.decode_ids(bpe_matrix.encode_texts(docs, RANKS, public.PATTERN), RANKS, public.PATTERN)
    one = bpe_matrix.encode_and_decode(docs, RANKS, public.PATTERN)
    assert sorted(one.collect()) == sorted(two.collect())

"""A training corpus from ``documents``: stages that are written as Parquet and read again.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last
return the columns of documents. Extra columns pass through; a null id stays null and is never dropped
as a copy; an empty table gives empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgewatch.llm import bpe_matrix, line_dedup, positional_index, ppm_language, shingle_join
from edgewatch.llm.rows import bounded_batches, without, without_texts
from edgewatch.session import materialize

SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and texts without a letter.

    Where no document has a label to learn from, all texts with a letter stay.
    """
    bounded_batches(spark)
    found = ppm_language.identify_language(docs, ppm_language.train(docs), carry=docs.columns)
    kept = found.filter(F.col("lettered"))
    return kept.select(*(F.col("carried").getField(c).alias(c) for c in docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that a document of a larger id keeps; ``n_chars`` follows the text."""
    bounded_batches(spark)
    kept = line_dedup.drop_repeated_lines(docs, carry=docs.columns)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*(new.get(c, F.col("carried").getField(c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group.

    A row goes if its own text has a near copy under a smaller id. Rows with a null id stay. Where one id
    has several texts, all rows of the id go with the one that is a copy.
    """
    bounded_batches(spark)
    groups = shingle_join.near_duplicate_groups(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)
    others = groups.filter("doc_id != component_id").select("doc_id").distinct()
    return without(docs, materialize(others, "copies"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item.

    A null id or one id with several texts: each row goes or stays by its own text.
    """
    bounded_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = positional_index.contamination(docs, items)
    hit = found.filter(F.size("items") > 0).select("doc_id", "digest").distinct()
    return without_texts(docs, materialize(hit, "contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every kept text and the bytes that they decode to."""
    bounded_batches(spark)
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_matrix.encode_and_decode(docs, vocabulary, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: Language ID and the encoding cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

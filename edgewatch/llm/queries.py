"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgewatch.llm import (
    bpe_matrix,
    importance_planes,
    line_dedup,
    minhash_forest,
    paragraph_sketch,
    positional_index,
    ppm_language,
    secret_scan,
    shingle_join,
    square_catchers,
    token_counts,
    warc,
    wrapper_induction,
)
from edgewatch.llm.rows import bounded_batches
from edgewatch.session import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe_matrix.encode_texts(
        _table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN
    )
    return bpe_matrix.decode_ids(encoded, vocabulary, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secret_scan.find_secrets(docs, secret_scan.train(docs))

    def listed(spans):
        text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.concat_ws(",", text)

    def of_kind(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    base = F.filter("spans", lambda s: s["kind"] != "model")
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_duplicate_groups(_table(spark, sf_dir, "documents"), words=3, percent=90)


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_sketch.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    lengths = F.zip_with("starts", "ends", lambda start, end: end - start)
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper_induction.extract_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.scratch_path(shared_dir(spark))
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.read_records(spark, path).select(
        warc.page_id_of(F.col("record_id")).alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        warc.page_id_of(F.col("refers_to")).alias("refers_to"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = ppm_language.identify_language(docs, ppm_language.train(docs))
    return found.select(
        "doc_id",
        ppm_language.held_out(F.col("doc_id")).alias("held_out"),
        F.col("lang").alias("lang_pred"),
        "score",
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = square_catchers.collapse_runs(
        _table(spark, sf_dir, "documents"), least_length=24, edit=square_catchers.with_period
    )

    def before(a, b):
        """Whether run ``a`` comes first: greater length / period, then smaller start, then period."""
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        tie = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))
        return (left > right) | ((left == right) & tie)

    best = F.try_element_at(F.array_sort("runs", lambda a, b: F.when(before(a, b), -1).when(before(b, a), 1).otherwise(0)), F.lit(1))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col("best").getField(c).alias(c) for c in ("start", "length", "period")),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_planes.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_token_counts": op3_token_counts,
    "op4_secret_scan": op4_secret_scan,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_decontamination": op7_decontamination,
    "op8_html_extraction": op8_html_extraction,
    "op9_warc": op9_warc,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

#: Stripped at both ends and lower-cased as the operators do it, A-Z only.
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_NOT_WORD = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes: every byte is added, then eight bits are shifted out."""
    byte = f"CAST(concat('0x', substr(hex(encode({text})), 2 * i - 1, 2)) AS BIGINT)"
    bytes_of = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: {byte})"
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_of}), lambda c, b: {step}), 4294967295)"


def _similar(percent: int) -> str:
    """CTEs ``sized`` and ``classes``: shingles of each document, and the smallest id that links reach."""
    return f"""WITH RECURSIVE
cut AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
  ELSE list_transform(range(1, len(w) - 1), lambda i: list_slice(w, i, i + 2)) END) AS s FROM cut),
sized AS (SELECT doc_id, len(s) AS n FROM sets),
rows AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM rows a JOIN rows b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * c >= {percent} * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sized
  UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
classes AS (SELECT r.a AS doc_id, any_value(n) AS n_shingles, min(r.b) AS component_id
  FROM reach r JOIN sized ON sized.doc_id = r.a GROUP BY r.a)"""


ORACLE_SQL = {
    "op1_line_dedup": f"""WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM split),
keyed AS (SELECT *, translate(trim(line, {_SPACE}), {_LETTERS}) AS key FROM lines),
shared AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped
  FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op5_ngram_jaccard_join": f"{_similar(90)} SELECT doc_id, n_shingles, component_id FROM classes",
    "op13_minhash_near_dedup": f"""{_similar(85)}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM classes""",
    "op7_decontamination": f"""WITH
doc_words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}),
  {_NOT_WORD}), lambda x: x <> '') AS w FROM documents),
item_words AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}),
  {_NOT_WORD}), lambda x: x <> '') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS w FROM (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sized AS (SELECT DISTINCT w, len(w) AS n FROM windows),
grams AS (SELECT doc_id, i, list_slice(w, i, i + n - 1) AS w, n FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM doc_words, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)),
found AS (SELECT g.doc_id, g.i, g.n, g.w FROM grams g JOIN sized USING (w)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found JOIN windows USING (w)) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_periodic_runs": f"""WITH
cut AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
  lambda x: x <> '') AS w, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
sized AS (SELECT *, len(w) AS n, h // 10 AS g FROM cut),
placed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized),
cycled AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
texts AS MATERIALIZED (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
  list_transform(range(0, n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM cycled),
words AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM texts),
equal AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i),
grouped AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM grouped GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL),
listed AS (SELECT doc_id, count(*) AS n_runs,
  string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
  max(CAST(length AS HUGEINT) * 1000000000000 // period) AS most FROM runs GROUP BY doc_id),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id
  ORDER BY CAST(length AS HUGEINT) * 1000000000000 // period DESC, start, period) AS place FROM runs) WHERE place = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op12_importance_resampling": f"""WITH
doc_words AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}),
  {_NOT_WORD}), lambda x: x <> '') AS w FROM documents),
features AS MATERIALIZED (SELECT doc_id, unnest(w) AS word FROM doc_words),
targets AS MATERIALIZED (SELECT unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}),
  {_NOT_WORD}), lambda x: x <> '')) AS word FROM benchmark),
spelled AS (SELECT DISTINCT word FROM (SELECT word FROM features UNION ALL SELECT word FROM targets)),
hashed AS MATERIALIZED (SELECT word, {_crc32("word")} % 10000 AS bucket FROM spelled),
corpus AS (SELECT bucket, count(*) AS s FROM features JOIN hashed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM targets JOIN hashed USING (word) GROUP BY bucket),
gains AS MATERIALIZED (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM features) + 10000)
  AS DOUBLE) / CAST((coalesce(s, 0) + 1) * ((SELECT count(*) FROM targets) + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM corpus FULL JOIN target USING (bucket)),
weights AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM features JOIN hashed USING (word)
  JOIN gains USING (bucket) GROUP BY doc_id),
scored AS MATERIALIZED (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(concat('0x', substr(sha256('2024:' || doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE)
  / 4294967296::DOUBLE))) AS BIGINT) AS score FROM doc_words LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20),
drawn AS (SELECT * FROM ranked WHERE rank <= 10 * (SELECT count(*) FROM ranked) // 100)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)""",
    "op9_warc": """WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
kept AS (SELECT payload_digest, max(page_id) AS keeper FROM payloads WHERE payload_bytes >= 1000
  GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM payloads LEFT JOIN kept USING (payload_digest)""",
}

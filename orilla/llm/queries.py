"""The operators' queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orilla.llm import decontaminate, html_wrappers, line_dedup, ngram_join, packing, pii_sanitise, quality_ledger, secret_scan, token_counts, toxicity


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.groups(_docs(spark, sf_dir), width=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_ledger.ledger(_docs(spark, sf_dir))
    judged = quality_ledger.apply_policy(rows, quality_ledger.POLICIES["v1"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", quality_ledger.fails(quality_ledger.mask_of(quality_ledger.BASE)).alias("base_failed"), "kept", "bits")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_sanitise.find_pii(_docs(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(_docs(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a folder that lasts is given by the session; without one the cache starts empty
    cache = spark.conf.get("spark.orilla.tokenCache", None)
    return token_counts.count_tokens(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), cache)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_docs(spark, sf_dir)).select("doc_id", "text", "n_removed_lines", "n_removed_words")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ngram_jaccard_join, op2_quality_rules, op3_decontamination, op4_pii, op5_secret_scan, op6_token_counts, op7_line_dedup, op8_best_fit_packing, op9_toxicity, op10_html_wrappers)}


_WORDS = r"[^\x20\x09-\x0D]+"

OP1_SQL = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM w),
s AS (SELECT doc_id, unnest(g) AS s FROM g), n AS (SELECT doc_id, len(g)::BIGINT AS n FROM g),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 90 * (a.n + b.n - shared)),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT n.doc_id, n.n AS n_shingles, min(r.y) AS component_id FROM n JOIN r ON r.x = n.doc_id GROUP BY 1, 2"""

OP2_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '{_WORDS}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM d),
g AS (SELECT k, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w WHERE len(w) >= 3),
f AS (SELECT k, i FROM g QUALIFY count(*) OVER (PARTITION BY k, g) > 1),
c AS (SELECT k, count(DISTINCT i + j)::BIGINT AS n_repeat_words FROM f, (SELECT unnest([0, 1, 2]) AS j) GROUP BY 1),
m AS (SELECT k, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ln)::BIGINT AS n_lines, (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{{80}}-\x{{10FFFF}}]')))::BIGINT AS n_letter_words, coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest_word FROM w LEFT JOIN c USING (k)),
b AS (SELECT *, ({" + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END" for i, r in enumerate(quality_ledger.RULES))})::BIGINT AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & {quality_ledger.mask_of(quality_ledger.BASE)}) <> 0 AS base_failed, (bits & {quality_ledger.POLICIES["v1"].mask}) = 0 AS kept, bits FROM b"""


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express; tests hold the others against brute force."""
    return {"op1_ngram_jaccard_join": OP1_SQL, "op2_quality_rules": OP2_SQL}

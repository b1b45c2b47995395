"""Registered queries: one for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (
    alignment,
    curve_search,
    decontaminate,
    exact_dedup,
    html_text,
    langid,
    line_dedup,
    ngram_join,
    packing,
    pii,
    secret_scan,
    toxicity,
    vector_codes,
)
from lakemart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_rows(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_rows(table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.duplicate_lines(table(spark, sf_dir, "documents"), every_position=True)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_rows(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op11_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return curve_search.search(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), tokenizer_path(),
                               tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_language_id, op2_packing, op3_html_text, op4_ngram_join, op5_decontamination,
    op6_toxicity, op7_exact_dedup, op8_line_dedup, op9_pii, op10_secrets, op11_curve_search,
    op12_vector_codes, op13_token_alignment)}

SQL: dict[str, str] = {}

SQL["op7_exact_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY norm)
"""

SQL["op12_vector_codes"] = vector_codes.sql()

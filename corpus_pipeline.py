"""A corpus pipeline: five operators in turn, each on all that the one before kept.

Every stage is a function (spark, docs, sf_dir) -> DataFrame.  ``run`` writes each
stage's result as Parquet in the shared checkpoint folder and reads it back as
the next stage's ``docs``.  All stages but the last return the columns of
``documents``; the last returns the packed pieces (see ``lakemart.llm.packing``).
Null, empty, repeated and very long texts follow the rules of each operator.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import decontaminate, exact_dedup, langid, ngram_join, packing
from lakemart.llm.common import held_out, spare_workers, stage, table
from lakemart.llm.queries import tokenizer_path


def _sparing(apply):
    """A stage whose Python workers, which the next ones use too, keep little memory between batches."""
    @wraps(apply)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spare_workers(spark)
        return apply(spark, docs, sf_dir)

    return run_stage


@_sparing
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a determined language: null, or no letter in them."""
    profiles = langid.fit_profiles(docs.where(~held_out("doc_id")))
    return langid.keep_identified(docs, profiles)


@_sparing
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of texts that are equal up to ASCII white space."""
    return exact_dedup.drop_exact_duplicates(docs)


@_sparing
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of near duplicates."""
    return ngram_join.keep_one_of_each(docs)


@_sparing
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


@_sparing
def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, in windows of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_windows),
]

#: Trained profiles, seeds and differencing can't be put in SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Documents to training tokens: language ID, line dedup, near-duplicate removal,
benchmark decontamination, BPE. Each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import bpe, decontaminate, language_id, line_dedup, ngram_join
from sieveline.llm.queries import VOCABULARY, table
from sieveline.shared import written

#: Score below which no language holds enough of a text.
LEAST_SCORE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a main language go; a missing ``lang`` is
    filled in."""
    others = tuple(c for c in docs.columns if c != "doc_id")
    found = language_id.identify(docs, language_id.fit(docs), keep=others)
    kept = found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each component stays; documents whose last line goes, go."""
    done = line_dedup.apply_removals(docs, line_dedup.removals(docs))
    kept = done.where(F.col("removed").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return ngram_join.keep_one(docs).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the tokens of each document that is left."""
    return bpe.round_trip(docs, VOCABULARY)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", deduplicate_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("bpe", tokenize),
]

# Scores, signatures and merges have no SQL; tests compare a small corpus stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

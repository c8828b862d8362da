"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sieveline.llm import (
    bpe,
    centroids,
    decontaminate,
    divergence,
    html_text,
    language_id,
    line_dedup,
    ngram_join,
    prefix_trie,
    pseudonyms,
    token_counts,
    token_store,
    warc,
)
from sieveline.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]

# The key of a run is the caller's secret; this one is for the query alone.
KEY = "acceptance"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark, table(spark, sf_dir, "pages"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents")).drop("text_hash")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.replace(table(spark, sf_dir, "documents"), KEY)


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store(spark, table(spark, sf_dir, "documents"), VOCABULARY, end_id=2)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_line_dedup": op2_line_dedup,
    "op3_language_id": op3_language_id,
    "op4_warc": op4_warc,
    "op5_ngram_join": op5_ngram_join,
    "op6_html": op6_html,
    "op7_decontaminate": op7_decontaminate,
    "op8_divergence": op8_divergence,
    "op9_pseudonyms": op9_pseudonyms,
    "op10_token_store": op10_token_store,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_centroids": op12_centroids,
    "op13_token_counts": op13_token_counts,
}

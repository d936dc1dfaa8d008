"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    embedding_dedup, exact_dedup, hilbert, html_extract, language_id, mixing, packing, prefix_trie, quality, simhash,
    suffix_dedup, url_filter, whitening)
from .common import table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_near_dedup(table(spark, sf_dir, "embeddings"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~language_id.held_out("doc_id")))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score", "ambiguous")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dedup(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).drop("removed")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), digest=True)


def op10_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(table(spark, sf_dir, "documents")).drop("cell")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))  # null beyond the range of a long


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_embedding_near_dedup, op2_url_filter, op3_exact_dedup, op4_language_id, op5_simhash_near_dedup,
        op6_html_extract, op7_source_mixing,
        op8_suffix_dedup, op9_best_fit_packing, op10_hilbert_sharding, op11_quality_classifier,
        op12_embedding_whitening, op13_conversation_trie)
}

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": embedding_dedup.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op7_source_mixing": mixing.SQL,
}

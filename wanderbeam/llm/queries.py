"""Queries opN over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderbeam.llm import (
    conversation_trie,
    decontamination,
    filter_audit,
    language_model,
    mixing,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
    vector_tree,
)
from wanderbeam.llm.sql import FILTER_AUDIT_SQL, MIXING_SQL, PREFIX_TRIE_SQL, QUALITY_RULES_SQL, SHARDING_SQL, SUBSTRING_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.document_scores(table(spark, sf_dir, "documents"))


def op3_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "mix_tokens", "mix_block", "mix_key")


def op4_boosted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.page_verdicts(table(spark, sf_dir, "pages"))


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents"))


def op6_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_components(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.document_rules(table(spark, sf_dir, "documents"))


def op8_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substring_dedup.repeats_removed(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.document_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_tree.nearest_neighbours(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_counterfactual_toxicity,
        op2_recurrent_lm,
        op3_temperature_mixing,
        op4_boosted_urls,
        op5_byte_shards,
        op6_simhash_blocks,
        op7_quality_rules,
        op8_difference_cover,
        op9_simhash_windows,
        op10_nbsvm_quality,
        op11_filter_audit,
        op12_prefix_trie,
        op13_kmeans_tree,
    )
}

ORACLES: dict[str, str] = {
    "op3_temperature_mixing": MIXING_SQL,
    "op5_byte_shards": SHARDING_SQL,
    "op7_quality_rules": QUALITY_RULES_SQL,
    "op8_difference_cover": SUBSTRING_SQL,
    "op11_filter_audit": FILTER_AUDIT_SQL,
    "op12_prefix_trie": PREFIX_TRIE_SQL,
}

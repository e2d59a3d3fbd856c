"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import (
    chat,
    decontaminate,
    divergence,
    mil_quality,
    mixing,
    pii,
    quality_rules,
    sharding,
    simhash,
    spelling,
    suffix_dedup,
    toxicity,
    urls,
)
from terrace.llm.tables import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


def op3_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.digest(table(spark, sf_dir, "pages"))


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"), n_shards=40)


def op5_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil_quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op7_splitting_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op8_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


def op9_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.digest(table(spark, sf_dir, "documents"))


def op12_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_cascade": op3_url_cascade,
    "op4_feistel_shards": op4_feistel_shards,
    "op5_attention_mil": op5_attention_mil,
    "op6_crf_pii": op6_crf_pii,
    "op7_splitting_tree_mix": op7_splitting_tree_mix,
    "op8_chat_parts": op8_chat_parts,
    "op9_edit_decontamination": op9_edit_decontamination,
    "op10_simhash": op10_simhash,
    "op11_source_divergence": op11_source_divergence,
    "op12_string_kernel_toxicity": op12_string_kernel_toxicity,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": quality_rules.DIGEST_SQL,
    "op3_url_cascade": urls.DIGEST_SQL,
    "op8_chat_parts": chat.DIGEST_SQL,
    "op11_source_divergence": divergence.DIGEST_SQL,
}

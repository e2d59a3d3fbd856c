"""The corpus pipeline: documents through the training-data operators, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import decontaminate, mixing, quality_rules, sharding, simhash
from terrace.llm.tables import finished, table
from terrace.session import scratch_dir
from terrace.sources.tables import remove_folder

N_SHARDS = 40


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the repetition rules reject go."""
    return quality_rules.keep(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (the smallest doc_id) stays."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times), by the mix's shards and shuffled in them."""
    return mixing.laid_out(mixing.mix(docs, prefix="__mix_"), "__mix_").select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot: the corpus in training order."""
    return sharding.assign(docs, N_SHARDS).withColumn("law", F.lit("rows"))


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: Embedding, hypergeometric draws and the permutation cannot be said in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next.

    A stage's own intermediates go once it is written, and its output once the next
    stage is; the last stage's input stays, since the result reads it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = scratch_dir(spark, f"pipeline-{k}")
        docs = finished(spark, lambda: stage(spark, docs, sf_dir), path)
        if before is not None:
            remove_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)

"""Reproducible global shuffle into shards: a Feistel permutation of row numbers.

Rows get global numbers in the order of ``doc_id`` (ties by size and
checksum; rows that tie in all three are alike here). The number's image under
the permutation gives shard (image mod shards) and slot (image div shards), so
shard sizes differ by one row at most, slots are gapless, and both can be
computed from the row number alone, or back from shard and slot.

Defined cases: a null text has size 16 and checksum 0; null ids are numbered
first; repeated rows each get a slot of their own; an empty table gives no
rows. Input columns named like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.feistel import permute, round_keys
from terrace.llm.tables import row_numbers

SEED = 20240229


def locate(row: np.ndarray, n_rows: int, n_shards: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of global row numbers."""
    image = permute(row, n_rows, round_keys(seed))
    return image % n_shards, image // n_shards


def row_at(shard: np.ndarray, slot: np.ndarray, n_rows: int, n_shards: int, seed: int = SEED) -> np.ndarray:
    """The global row number that lies at (shard, slot)."""
    return permute(slot * n_shards + shard, n_rows, round_keys(seed), inverse=True)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``size`` (UTF-8 bytes of the text and 16) and ``text_crc32``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns(
        {"size": F.octet_length(text).cast("long") + 16, "text_crc32": F.crc32(text.cast("binary")).cast("long")}
    )


def place(sized: DataFrame, n_shards: int, seed: int = SEED) -> DataFrame:
    """Rows with ``doc_id``, ``size`` and ``text_crc32``, plus ``shard`` and ``slot``."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    numbered, n_rows = row_numbers(sized.drop("shard", "slot"), order, "shard-rows")

    @F.arrow_udf("struct<shard: int, slot: long>")
    def located(row: pa.Array) -> pa.Array:  # only the row number goes to Python
        shard, slot = locate(row.to_numpy(zero_copy_only=False), n_rows, n_shards, seed)
        return pa.StructArray.from_arrays([pa.array(shard.astype(np.int32)), pa.array(slot)], names=["shard", "slot"])

    placed = numbered.withColumn("__place", located("__row"))
    columns = [c for c in numbered.columns if c != "__row"]
    return placed.select(*columns, F.col("__place.shard").alias("shard"), F.col("__place.slot").alias("slot"))


def assign(docs: DataFrame, n_shards: int, seed: int = SEED) -> DataFrame:
    """``docs`` plus ``size``, ``text_crc32``, ``shard`` and ``slot``."""
    return place(measured(docs), n_shards, seed)


def digest(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    return place(measured(docs).select("doc_id", "size", "text_crc32"), n_shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

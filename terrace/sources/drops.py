"""Drops of sheet rows that Spark itself reads and writes: JSON lines.

A drop is a folder with a ``file=<name>`` folder per source file (as many part
files in it as its size asks for); a line holds the sheet, the row's number and
its cells; row number 0 is a header line. ``cells`` gives the same frame as the workbook parser, so everything
after it is shared, and no Python runs on the executors. A line that cannot be
read has row number -1 and a problem.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources import tables

LINE_SCHEMA = "sheet string, sheet_no int, row_no long, cells array<string>, file string"
#: Shuffled bytes of dealt rows per task; the texts derived from them are many times larger.
DEALT_BYTES = 4 * 1024 * 1024
BAD_LINE = "line without a row number"


def write_drop(rows: DataFrame, folder: str, dealt: bool = False, compression: str | None = None) -> None:
    """``rows``: file, sheet, sheet_no, row_no, cells. Files are written as large as they come, a hot one by many tasks.

    ``dealt``: the rows come by file already (:func:`deal`), so that their texts are not shuffled.
    """
    cols = [c.split()[0] for c in LINE_SCHEMA.split(", ")]
    rows = rows.select(*cols) if dealt else rows.select(*cols).hint("rebalance", "file")
    parts = tables.at_most(rows.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", DEALT_BYTES) if dealt else nullcontext()
    with parts, tables.compiled(rows.sparkSession):
        rows.write.mode("append").partitionBy("file").json(folder, compression=compression)


def deal(rows: DataFrame, by: Column) -> DataFrame:
    """``rows`` that a drop is derived from, by what tells its files apart: numbers are
    shuffled instead of the texts made of them, a hot file over many tasks."""
    return rows.withColumn("_file", by).hint("rebalance", "_file").drop("_file")


def part_file() -> list[Column]:
    """(path, size, modified) of the part file a line came from, spelt as file listings spell them."""
    decoded = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    return [
        F.regexp_replace(decoded, "^file:/+", "file:/").alias("part_path"),
        F.col("_metadata.file_size").alias("part_size"),
        F.col("_metadata.file_modification_time").alias("part_modified"),
    ]


def _cells(lines: DataFrame, folder: str, *more: Column) -> DataFrame:
    bad = F.col("row_no").isNull()
    return lines.select(
        F.concat(F.lit(folder.rstrip("/") + "/"), F.col("file")).alias("path"),
        "sheet",
        "sheet_no",
        F.when(bad, F.lit(-1)).otherwise(F.col("row_no")).cast("long").alias("row_no"),
        F.coalesce(F.size("cells"), F.lit(0)).alias("width"),
        "cells",
        F.when(bad, F.lit(BAD_LINE)).alias("problem"),
        *more,
    )


def read_drop(spark: SparkSession, folder: str, parts: Sequence[str] | None = None) -> DataFrame:
    """The drop's rows as parsed cells, or those of some part files; the width is each row's own."""
    reader = spark.read.schema(LINE_SCHEMA)
    lines = reader.json(folder) if parts is None else reader.option("basePath", folder).json(list(parts))
    return _cells(lines, folder)


def stream_drop(spark: SparkSession, folder: str, options: dict | None = None) -> DataFrame:
    """New part files of a drop as a stream of parsed cells, each with its part file."""
    lines = spark.readStream.schema(LINE_SCHEMA).options(**(options or {})).json(folder)
    return _cells(lines, folder, *part_file())

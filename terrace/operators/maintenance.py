"""Upkeep of tables that grow by appends: only the partitions that need it are rewritten.

A partition (folder) is the unit that a plain Parquet table can replace in one
write (dynamic partition overwrite, as in the merge); all files of other partitions
stay as they are, under their names. In a partition that is rewritten, large files are
rewritten with the small ones. What needs work is found from the listing (sizes)
or from the ranges of the clustering columns; the driver holds a line per
file of the partitions to be rewritten.

Defined cases: NULL partition values are a partition like any other; an empty
table needs nothing; tables without partitions, or with buckets (where a file
is a bucket), are refused: ``layout`` rewrites those whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators import layout
from terrace.operators.upsert import buckets_of, partition_filter
from terrace.sources import tables

#: The folder name of a NULL partition value (fixed value).
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    cols = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not cols:
        raise ValueError(f"{name} has no partitions")
    if buckets_of(spark, name):
        raise ValueError(f"{name} is bucketed: its files are its buckets")
    return cols


def listed(spark: SparkSession, name: str, cols: Sequence[str]) -> DataFrame:
    """``tables.files`` with the partition columns' values."""
    kinds = {f.name: f.dataType for f in spark.table(name).schema.fields}
    folder = F.concat(F.lit("/"), "partition", F.lit("/"))
    values = {}
    for c in cols:
        raw = F.regexp_extract(folder, f"/{re.escape(c)}=([^/]*)/", 1)
        plain = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
        values[c] = F.when(raw != NULL_FOLDER, plain).cast(kinds[c])
    return tables.files(spark, name).withColumns(values)


def _replace(spark: SparkSession, name: str, df: DataFrame) -> None:
    with tables.setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def compact_partitions(
    spark: SparkSession, name: str, file_bytes: int = layout.DEFAULT_FILE_BYTES, least_small: int = 2
) -> list[tuple]:
    """Pack the small files (under half of ``file_bytes``) of each partition that has ``least_small`` or more.

    Files are packed in the order of their names into bins of about ``file_bytes``; larger
    files are bins of their own. Rows keep their order within a file, so narrow ranges stay
    narrow. Each bin is a task and a file. Returns the values of the partitions rewritten.
    """
    cols = partition_columns(spark, name)
    spark.catalog.refreshTable(name)
    files = listed(spark, name, cols).withColumn("small", F.col("bytes") < file_bytes / 2)
    busy = files.groupBy("partition").agg(F.count_if("small").alias("n")).where(F.col("n") >= least_small).select("partition")
    earlier = Window.partitionBy("partition").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    packed = F.coalesce(F.sum(F.when(F.col("small"), F.col("bytes"))).over(earlier), F.lit(0))
    number = F.when(F.col("small"), F.floor(packed / file_bytes).cast("string")).otherwise(F.col("file"))
    plan = files.withColumn("bin", number).join(busy, "partition", "left_semi").select("partition", "bin", "file", *cols).collect()
    if not plan:
        return []
    ids = {key: i for i, key in enumerate(sorted({(r["partition"], r["bin"]) for r in plan}))}
    touched = sorted({tuple(r[c] for c in cols) for r in plan}, key=str)
    kinds = {f.name: f.dataType for f in spark.table(name).schema.fields}
    bins = spark.createDataFrame(
        [(*(r[c] for c in cols), r["file"], ids[r["partition"], r["bin"]]) for r in plan],
        T.StructType(
            [*(T.StructField(f"__p{i}", kinds[c]) for i, c in enumerate(cols)), T.StructField("__name", T.StringType()), T.StructField("__bin", T.IntegerType())]
        ),
    )
    rows = (
        spark.table(name)
        .where(partition_filter(cols, touched))
        .select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"__p{i}")) for i, c in enumerate(cols)]
    # a left join: rows of a file that came after the listing go to some bin, and are not lost
    dealt = rows.join(bins, reduce(lambda a, b: a & b, same, F.col("__file") == F.col("__name")), "left")
    _replace(
        spark,
        name,
        dealt.withColumn("__bin", F.coalesce("__bin", F.lit(0)))
        .repartitionById(len(ids), F.col("__bin"))
        .sortWithinPartitions(*cols, "__file", "__at"),
    )
    return touched


def overlap(spark: SparkSession, name: str, by: Sequence[str]) -> DataFrame:
    """Per partition: ``files``, and ``depth``, the most files that a lookup of one value of one of ``by`` opens.

    A sweep over the files' ranges: at a range's start one more is open, after its end one
    less. Files that hold one value only are not counted: a lookup of it needs them.
    """
    cols = partition_columns(spark, name)
    ends = [f(c).alias(f"__{k}{i}") for i, c in enumerate(by) for k, f in (("lo", F.min), ("hi", F.max))]
    files = spark.table(name).groupBy(*cols, F.col("_metadata.file_name").alias("__file")).agg(*ends)
    sweep = Window.partitionBy(*cols).orderBy("v", "shut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = files.select(*cols, F.lit(1).alias("files"), F.lit(1).cast("long").alias("depth"))
    for i in range(len(by)):
        wide = files.where(F.col(f"__lo{i}") < F.col(f"__hi{i}"))
        start = wide.select(*cols, F.col(f"__lo{i}").alias("v"), F.lit(0).alias("shut"), F.lit(1).alias("step"))
        stop = wide.select(*cols, F.col(f"__hi{i}").alias("v"), F.lit(1).alias("shut"), F.lit(-1).alias("step"))
        out = out.union(start.union(stop).select(*cols, F.lit(0), F.sum("step").over(sweep)))
    return out.groupBy(*cols).agg(F.sum("files").alias("files"), F.max("depth").alias("depth"))


def recluster_partitions(
    spark: SparkSession,
    name: str,
    by: Sequence[str],
    file_bytes: int = layout.DEFAULT_FILE_BYTES,
    max_depth: int | None = None,
) -> list[tuple]:
    """Cluster anew (z-order on ``by``) the partitions whose files overlap more than ``max_depth`` deep.

    By default twice the depth of a well-clustered partition of as many files: with d
    columns, files ** (1 - 1/d). All partitions chosen are clustered in one job. A partition that
    clustering leaves above ``max_depth`` is chosen again next time; allow it more.
    Returns the values of the partitions rewritten.
    """
    cols = partition_columns(spark, name)
    spark.catalog.refreshTable(name)
    well = F.ceil(F.pow("files", F.lit(1 - 1 / len(by))) - F.lit(1e-9))
    allowed = F.lit(max_depth) if max_depth else 2 * well
    chosen = [tuple(r) for r in overlap(spark, name, by).where(F.col("depth") > allowed).select(*cols).collect()]
    if not chosen:
        return []
    held = listed(spark, name, cols).where(partition_filter(cols, chosen)).agg(F.sum("bytes")).first()[0] or 0
    n = max(len(chosen), math.ceil(held / file_bytes))
    rows = spark.table(name).where(partition_filter(cols, chosen))
    key = layout.zorder_key(rows, by, layout.zorder_bits(n, len(by)))
    order = [*cols, "__z", *by, "__h"]
    tagged = rows.withColumn("__z", key).withColumn("__h", F.xxhash64(*rows.columns))
    _replace(spark, name, tagged.repartitionByRange(n, *order).sortWithinPartitions(*order))
    return chosen

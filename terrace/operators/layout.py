"""Physical layout of stored tables: compaction, multi-column clustering
(z-order), and column statistics.

Plain parquet has no OPTIMIZE; these rewrite the data with ordinary Spark
writes and leave the swap to :func:`terrace.sources.tables.publish_version`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from terrace.sources.tables import stored_bytes

DEFAULT_FILE_BYTES = 128 * 1024 * 1024


def file_count(spark: SparkSession, path: str, suffix: str = ".parquet") -> int:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    it = fs.listFiles(p, True)
    n = 0
    while it.hasNext():
        if it.next().getPath().getName().endswith(suffix):
            n += 1
    return n


def compact(df: DataFrame, total_bytes: int, file_bytes: int = DEFAULT_FILE_BYTES) -> DataFrame:
    """Fewer, larger files: ``ceil(total / file_bytes)`` output partitions.

    Going down in partition count uses ``coalesce`` (neighbouring input
    splits are concatenated, no shuffle); going up would need a shuffle and
    is done with ``repartition``.
    """
    n = max(1, math.ceil(total_bytes / file_bytes))
    current = df.rdd.getNumPartitions()
    return df.coalesce(n) if n < current else df.repartition(n)


def compact_path(spark: SparkSession, src: str, dst: str, file_bytes: int = DEFAULT_FILE_BYTES) -> int:
    """Rewrite the parquet folder ``src`` into ``dst`` with target-size files.
    Returns the number of output partitions."""
    df = spark.read.parquet(src)
    out = compact(df, stored_bytes(spark, src), file_bytes)
    out.write.mode("overwrite").parquet(dst)
    return out.rdd.getNumPartitions()


def order_key(c: Column, dtype) -> Column:
    """A value that sorts like the column and is one of few types: numbers as
    doubles, strings as they are, dates and times as numbers."""
    if isinstance(dtype, NumericType):
        return c.cast("double")
    if isinstance(dtype, StringType):
        return c
    if dtype.typeName() == "date":
        return F.unix_date(c).cast("double")
    return F.unix_micros(c.cast("timestamp")).cast("double")


def _bucket(x: Column, bounds: Sequence) -> Column:
    """Index of the range ``x`` falls in (0..len(bounds)); NULL → 0. A binary
    search spelt out, so a row takes log2(len(bounds)) comparisons."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x <= F.lit(bounds[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    return F.when(x.isNull(), F.lit(0)).otherwise(search(0, len(bounds)))


SAMPLE_PER_RANGE = 32
MAX_BITS = 8


def zorder_bits(files: int, n_cols: int) -> int:
    """Bits per column: a few cells per file. More would not narrow the files'
    ranges; a cell is no limit, since its rows can be split (see ``zorder``)."""
    return max(2, min(MAX_BITS, 62 // n_cols, math.ceil(math.log2(max(files, 1)) / n_cols) + 2))


def range_bounds(df: DataFrame, keys: Sequence[Column], ranges: int) -> list[list]:
    """Per key, ascending values that cut the rows into about equal ranges.

    Taken from a uniform sample of ``ranges * SAMPLE_PER_RANGE`` rows: those
    with the smallest hash of all columns (a top-k, so only the sample
    reaches the driver). Works on any sortable type, strings whole.
    """
    keyed = df.select(*[k.alias(f"_k{i}") for i, k in enumerate(keys)], F.xxhash64(*df.columns).alias("_h"))
    rows = keyed.orderBy("_h").limit(ranges * SAMPLE_PER_RANGE).collect()
    out = []
    for i in range(len(keys)):
        values = sorted(r[i] for r in rows if r[i] is not None)
        out.append(sorted({values[len(values) * j // ranges] for j in range(1, ranges)}) if values else [])
    return out


def zorder_key(df: DataFrame, cols: Sequence[str], bits: int) -> Column:
    """Interleaved bits of each column's range index (2**bits ranges of about
    equal rows). Rows close in every column get close keys."""
    d = len(cols)
    if bits * d > 62:
        raise ValueError("too many columns or bits for a 64-bit key")
    types = {f.name: f.dataType for f in df.schema.fields}
    keys = [order_key(F.col(c), types[c]) for c in cols]
    buckets = [_bucket(k, b) for k, b in zip(keys, range_bounds(df, keys, 2**bits))]
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for j, b in enumerate(buckets):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(b, bit).bitwiseAND(1).cast("long"), bit * d + (d - 1 - j)))
    return z


def zorder(df: DataFrame, cols: Sequence[str], files: int, bits: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by the z-key, ready to write as
    ``files`` files whose min/max ranges are narrow in every column.

    Within a cell rows are ordered by the columns and a hash of the row, so
    neither a cell nor one value (NULL included) is bound to one partition:
    the number of files follows the number asked for.
    """
    z = zorder_key(df, cols, bits or zorder_bits(files, len(cols)))
    h = F.xxhash64(*df.columns)
    # key and hash are made on either side of the exchange instead of going through it
    dealt = df.repartitionByRange(files, z, *cols, h)
    return dealt.withColumn("_z", z).withColumn("_h", h).sortWithinPartitions("_z", *cols, "_h").drop("_z", "_h")


def file_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per stored file: min and max of each column (what parquet footers hold)."""
    f = F.col("_metadata.file_path")
    return df.groupBy(f.alias("file")).agg(
        *[F.min(c).alias(f"{c}_min") for c in cols], *[F.max(c).alias(f"{c}_max") for c in cols]
    )


def admits(col: str, value) -> Column:
    """On a ``file_ranges`` row: the file's [min, max] of ``col`` holds
    ``value``, so a lookup of that value must open the file."""
    v = F.lit(value)
    return (F.col(f"{col}_min") <= v) & (F.col(f"{col}_max") >= v)


def analyze_columns(spark: SparkSession, table: str, cols: Sequence[str]) -> DataFrame:
    """Compute column statistics and return them as rows
    ``(col_name, min, max, num_nulls, distinct_count)``."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(cols)}")
    out = None
    for c in cols:
        d = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {c}")
        kv = d.groupBy().pivot("info_name", ["min", "max", "num_nulls", "distinct_count"]).agg(F.first("info_value"))
        row = kv.select(
            F.lit(c).alias("col_name"),
            F.col("min").alias("min_value"),
            F.col("max").alias("max_value"),
            F.col("num_nulls").cast("long").alias("num_nulls"),
            F.col("distinct_count").cast("long").alias("distinct_count"),
        )
        out = row if out is None else out.unionByName(row)
    return out

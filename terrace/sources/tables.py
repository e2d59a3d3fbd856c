"""Table scans, existence checks, appends, overwrites and version swaps.

A stored table is a catalog table (``saveAsTable``). Replacing a table that
the same job also reads is done by writing a new version table and pointing
a view at it (no table format with row-level writes is assumed).
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import BASE_CONF


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the writes inside; the caller's value comes back."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


@contextmanager
def at_most(spark: SparkSession, key: str, size: int) -> Iterator[None]:
    """A session setting in bytes, lowered to ``size`` for the writes inside; a smaller one stays."""
    have = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    with setting(spark, key, f"{min(have, size)}b"):
        yield


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """For the writes inside, stages too large to JIT take Spark's non-fused path in any session,
    also one that :func:`terrace.session.get_session` did not make; a lower limit stays."""
    key = "spark.sql.codegen.hugeMethodLimit"
    with setting(spark, key, str(min(int(spark.conf.get(key)), int(BASE_CONF[key])))):
        yield


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan over the cluster's cores when it plans fewer splits
    than there are cores.

    A file with a single row group (or a non-splittable file) is read by one
    task however large it is, and every row-wise step fused into that stage
    then runs on one core. At warehouse scale a scan plans thousands of
    splits and this is a no-op; it only adds a shuffle when the input is too
    small or too unsplittable to keep the cores busy.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def read_parquet(spark: SparkSession, path: str, spread_out: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return spread(df) if spread_out else df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def is_empty(spark: SparkSession, name: str) -> bool:
    """True for a missing table or one without rows (reads at most one row)."""
    return not table_exists(spark, name) or spark.read.table(name).isEmpty()


def append(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Append to a catalog table (created on first use); a frame whose
    columns differ from the table's is refused, never merged in."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        w = df.write.format("parquet")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.saveAsTable(name)
        return
    have = {f.name: f.dataType for f in spark.read.table(name).schema.fields}
    want = {f.name: f.dataType for f in df.schema.fields}
    if have != want:
        raise ValueError(f"columns of the frame {want} differ from table {name} {have}")
    df.select(*spark.read.table(name).columns).write.insertInto(name)


def overwrite(df: DataFrame, name: str, partition_by: list[str] | None = None, location: str | None = None) -> None:
    """Replace (or create) a catalog table; ``location`` stores its files
    there instead of under the warehouse folder."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if location:
        w = w.option("path", location)
    with compiled(df.sparkSession):
        w.saveAsTable(name)


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _version_base(name: str) -> str:
    return re.sub(r"[^0-9A-Za-z_.]", "_", name)


def new_version_name(name: str) -> str:
    """Names sort by the time they were made."""
    return f"{_version_base(name)}__v{time.time_ns():020d}_{uuid.uuid4().hex[:6]}"


def versions(spark: SparkSession, name: str) -> list[str]:
    """Stored versions of ``name``, oldest first."""
    db, _, table = _version_base(name).rpartition(".")
    found = [t.name for t in spark.catalog.listTables(db or None, f"{table.lower()}__v*") if not t.isTemporary]
    return [f"{db}.{t}" if db else t for t in sorted(found)]


def drop_old_versions(spark: SparkSession, name: str, keep: int = 2, location_root: str | None = None) -> list[str]:
    """Drop all but the ``keep`` newest versions (the newest is behind the
    view), with their folders when they lie under ``location_root``."""
    old = versions(spark, name)[: -max(1, keep)]
    for version in old:
        folder = location(spark, version) if location_root else None
        spark.sql(f"DROP TABLE IF EXISTS {_ident(version)}")
        if folder and folder.rstrip("/").split("/")[-1].lower() == version.lower():
            remove_folder(spark, folder)
    return old


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def publish_version(
    df: DataFrame, name: str, partition_by: list[str] | None = None, location_root: str | None = None
) -> str:
    """Write ``df`` as a new version table and point the view ``name`` at it.

    Readers of ``name`` see the old version until the view swap, which is a
    single catalog operation. Old versions stay until :func:`drop_old_versions`. With ``location_root`` each version's files go to a folder of
    that name under it. Returns the version table's name.
    """
    spark = df.sparkSession
    version = new_version_name(name)
    overwrite(df, version, partition_by, f"{location_root.rstrip('/')}/{version}" if location_root else None)
    spark.sql(f"CREATE OR REPLACE VIEW {_ident(name)} AS SELECT * FROM {_ident(version)}")
    return version


def location(spark: SparkSession, name_or_path: str) -> str:
    """Storage folder of a catalog table (or the path itself)."""
    if "/" in name_or_path:
        return name_or_path
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(name_or_path)}").filter("col_name = 'Location'").collect()
    if not rows:
        raise ValueError(f"{name_or_path} has no storage location (a view?)")
    return rows[0]["data_type"]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a folder, from the file system's summary (no data read);
    0 when it does not exist."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Table detail as rows (``DESCRIBE TABLE EXTENDED``)."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(name)}")


def files(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A stored table's data files as rows: partition folder (below the table's own), file, bytes, modified.

    From the listing alone; no file is opened.
    """
    root = location(spark, name_or_path).rstrip("/")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    plain = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/+", "/")
    below = F.substring(plain(F.col("path")), F.length(plain(F.lit(root))) + F.lit(2), F.length("path"))
    return listed.select(
        F.regexp_extract(below, "^(.*)/[^/]*$", 1).alias("partition"),
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def detail(spark: SparkSession, name: str) -> DataFrame:
    """One row: files, bytes, partitions, least and greatest file, last change, and versions kept of a versioned table."""
    kept = versions(spark, name)
    stored = files(spark, kept[-1] if kept else name)
    return stored.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0).cast("long")).alias("bytes"),
        F.count_distinct("partition").alias("partitions"),
        F.min("bytes").alias("least_file"),
        F.max("bytes").alias("greatest_file"),
        F.max("modified").alias("last_change"),
        F.lit(len(kept)).cast("long").alias("versions"),
    )

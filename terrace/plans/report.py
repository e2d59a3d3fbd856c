"""The reporting table kept up to date by the policies that changed.

The table is partitioned by ``policy_part``, a hash of the policy. Every clean
upsert notes the policies of its batch (``note_changes``); a refresh joins the
clean rows of those policies only, takes the other rows of the parts they lie in
from the table itself, and replaces just these parts. A noted batch that was
already applied can be applied again without harm, so a run that dies is simply
run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.upsert import Buckets, buckets_of, co_located, dealt_alike
from terrace.plans import medallion
from terrace.plans.manifest import missing
from terrace.session import PACKED_BYTES_PER_PARTITION, scratch_dir
from terrace.sources import tables

POLICY, PART = "policy_id", "policy_part"
CHANGE_SCHEMA = "policy_id long, change_run string"
#: Table property: the number of parts it was made with.
PARTS_PROPERTY = "terrace.parts"


@dataclass
class Refresh:
    parts: int  # parts replaced
    policies: int  # policies that changed
    joined_rows: int  # report rows made anew, all of changed policies
    kept_rows: int  # rows of the same parts taken over from the table
    first: bool = False  # the whole table was built


def part_of(policy: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(policy), F.lit(parts)).cast("int")


def note_changes(batch: DataFrame, folder: str, run: str) -> None:
    """Note the policies of an upserted batch (a key holds its policy, so an update never moves a row to another)."""
    noted = batch.select(F.col(POLICY).cast("long").alias(POLICY)).where(F.col(POLICY).isNotNull()).distinct()
    lines = noted.withColumn("change_run", F.lit(run))
    with tables.compiled(batch.sparkSession):
        lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("change_run").parquet(
            f"{folder.rstrip('/')}/noted"
        )


def _read(spark: SparkSession, folder: str, part: str) -> DataFrame:
    try:
        return spark.read.schema(CHANGE_SCHEMA).parquet(f"{folder.rstrip('/')}/{part}")
    except AnalysisException as e:
        if not missing(e):
            raise
        return spark.createDataFrame([], CHANGE_SCHEMA)


def pending_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Noted policies of runs that no refresh has applied."""
    applied = _read(spark, folder, "applied").select("change_run").distinct()
    return _read(spark, folder, "noted").join(applied, "change_run", "left_anti")


def refresh_changed(
    spark: SparkSession,
    members_table: str,
    holders_table: str,
    report_table: str,
    changes: str,
    parts: int = 64,
    location: str | None = None,
) -> Refresh:
    """Bring the report up to date with the noted changes; the first call builds it whole.

    Over bucketed clean tables a task holds a bucket of them at most, whatever number
    of shuffle partitions the session asks for; the report's own rows are
    sorted in shuffles sized by what is stored of them.
    """
    members, holders = spark.read.table(members_table), spark.read.table(holders_table)
    scratch = scratch_dir(spark, "report-changes")
    pending_changes(spark, changes).write.parquet(scratch + "/pending")
    noted = spark.read.schema(CHANGE_SCHEMA).parquet(scratch + "/pending")
    first = not tables.table_exists(spark, report_table)
    with dealt_alike(spark, fewest_buckets(spark, members_table, holders_table)), co_located(spark):
        if first:
            fresh = medallion.consolidate(members, holders).withColumn(PART, part_of(F.col(POLICY), parts))
            result = _replace(fresh, None, report_table, scratch, location, True, parts)
        else:
            have = spark.table(report_table)
            parts = stored_parts(spark, report_table)
            noted.select(POLICY).distinct().withColumn(PART, part_of(F.col(POLICY), parts)).write.parquet(scratch + "/changed")
            changed = spark.read.parquet(scratch + "/changed")
            touched = sorted(r[0] for r in changed.select(PART).distinct().collect())  # one value per part at most
            only = lambda df: df.join(changed.select(POLICY), POLICY, "left_semi")
            fresh = medallion.consolidate(only(members), only(holders)).withColumn(PART, part_of(F.col(POLICY), parts))
            kept = have.where(F.col(PART).isin(touched)).join(changed.select(POLICY), POLICY, "left_anti")
            result = _replace(fresh, kept, report_table, scratch, location, False, parts)
            result.policies = changed.count()
    noted.select(POLICY, "change_run").groupBy("change_run").agg(F.count(F.lit(1)).alias(POLICY)).select(POLICY, "change_run").write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "dynamic").partitionBy("change_run").parquet(f"{changes.rstrip('/')}/applied")
    tables.remove_folder(spark, scratch)
    return result


def fewest_buckets(spark: SparkSession, *names: str) -> Buckets | None:
    """Of the tables that have buckets, the fewest: no more partitions than these, or Spark shuffles that table too."""
    found = [b for b in (buckets_of(spark, n) for n in names) if b]
    return min(found, key=lambda b: b.n, default=None)


def stored_parts(spark: SparkSession, name: str) -> int:
    """The number of parts the table was made with."""
    said = spark.sql(f"SHOW TBLPROPERTIES {name} ('{PARTS_PROPERTY}')").first()
    return int(said["value"])


def _replace(fresh: DataFrame, kept: DataFrame | None, name: str, scratch: str, location: str | None, first: bool, parts: int) -> Refresh:
    """Stage the new rows of the parts, then put them in the place of the old; files are clustered for lookups."""
    spark = fresh.sparkSession
    cols = [*medallion.GOLD_COLUMNS, PART]
    fresh.select(*cols).write.parquet(scratch + "/fresh")
    stage = spark.read.schema(fresh.select(*cols).schema).parquet(scratch + "/fresh")
    joined, taken = stage.count(), 0
    if kept is not None:
        kept.select(*cols).write.parquet(scratch + "/kept")
        old = spark.read.schema(stage.schema).parquet(scratch + "/kept")
        taken = old.count()
        stage = stage.unionByName(old)
    by = [F.col(c) for c in (PART, *medallion.GOLD_CLUSTER_BY)] + [F.xxhash64(*cols)]
    n_parts = stage.select(PART).distinct().count()
    stored = tables.stored_bytes(spark, scratch + "/fresh") + tables.stored_bytes(spark, scratch + "/kept")
    key = "spark.sql.shuffle.partitions"
    with tables.setting(spark, key, str(max(int(spark.conf.get(key)), -(-stored // PACKED_BYTES_PER_PARTITION)))):
        rows = stage.repartitionByRange(*by).sortWithinPartitions(*by)
        if first:
            w = rows.write.format("parquet").partitionBy(PART)
            (w.option("path", location) if location else w).saveAsTable(name)
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PARTS_PROPERTY}' = '{parts}')")
        else:
            with tables.setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
            spark.catalog.refreshTable(name)
    return Refresh(n_parts, 0, joined, taken, first)

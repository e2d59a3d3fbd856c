"""Raw-layer ingest: sheet rows of an inbox → an append-only all-text table.

One distributed job per run covers every pending file; the counts come from
observations on that same job. Batch and incremental ingest share one layout:
partitions ``load_date`` and ``ingest_run`` (one value per batch run, or per
micro-batch), so a run's own rows can be told from others of its date, and a run
that is done again replaces its own rows.

Every row seen is kept, blank, or in a sheet that the width guard did not accept;
the rows of those sheets go to a reject table of the same layout, in the same
run, with the reason.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.operators.frames import observed
from terrace.plans.manifest import Manifest, list_files
from terrace.session import scratch_dir
from terrace.sources import drops, sheets, tables
from terrace.sources import workbooks as wb

RUN_COL = "ingest_run"
PARTITIONS = ("load_date", RUN_COL)
#: Columns that say in which order raw rows came.
ARRIVAL = (RUN_COL, "source_file", "sheet_no", "row_no")
#: Bytes of drop files that one task reads, and so writes as one file of the raw table.
SPLIT_BYTES = 32 * 1024 * 1024


class NothingToIngest(RuntimeError):
    """The inbox holds no workbook, or none of its rows could be loaded."""


class SchemaMismatch(ValueError):
    """The rows' columns differ from the raw table's."""


@dataclass
class IngestResult:
    rows: int  # rows appended
    sheet_rows: int  # data rows seen in all sheets, before guards and blank-row removal
    blank_rows: int  # rows of accepted sheets without a value in any picked cell
    rejected_rows: int  # rows of sheets that were not accepted; they are in the reject table
    rejected_sheets: int  # sheets narrower than the layout needs
    unreadable: int  # sheets, files or lines that could not be parsed
    report: DataFrame  # per-file row counts of this run (lazy)
    loaded_files: list[str]  # paths of the files that gave at least one row in this run
    run: str  # this run's value in the raw table
    load_date: str  # the date its rows are stamped with (a run done again keeps its first)


def new_run() -> str:
    """Sorts by the time it was made; never read as a number or a date."""
    return f"r{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}_{uuid.uuid4().hex[:6]}"


def stored_schema(spark: SparkSession, target: str):
    """Columns of the raw table or folder; None while it has no data."""
    if "/" not in target:
        return spark.read.table(target).schema if tables.table_exists(spark, target) else None
    return spark.read.parquet(target).schema if tables.stored_bytes(spark, target) else None


def guard_schema(rows: DataFrame, target: str, partition_by: Sequence[str]) -> None:
    """Refuse rows whose columns are not the target's; columns never merge in.
    (Types of partition folders are inferred on reading, so only their names count.)"""
    have = stored_schema(rows.sparkSession, target)
    if have is None:
        return
    shape = lambda schema: {f.name: None if f.name in partition_by else f.dataType for f in schema}
    if shape(have) != shape(rows.schema):
        raise SchemaMismatch(f"columns {rows.schema.simpleString()} differ from those of {target}: {have.simpleString()}")


def write_rows(
    rows: DataFrame, target: str, partition_by: Sequence[str] = ("load_date",), rebalance: bool = True
) -> None:
    """Append to a catalog table (``db.name``) or a folder (a path).

    ``rebalance`` lets AQE size the output files (coalescing small write
    partitions to ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and
    splitting large ones) instead of one small file per parse task: the
    compaction the raw table would otherwise need after every load.
    """
    guard_schema(rows, target, partition_by)
    if rebalance:
        rows = rows.hint("rebalance")
    w = rows.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target:
        w.parquet(target)
    else:
        w.format("parquet").saveAsTable(target)


def read_target(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target) if "/" in target else spark.read.table(target)


def read_target_or_none(spark: SparkSession, target: str) -> DataFrame | None:
    """The raw table, or None before its first load."""
    return None if stored_schema(spark, target) is None else read_target(spark, target)


def write_run(rows: DataFrame, target: str, partition_by: Sequence[str] = PARTITIONS, rebalance: bool = True) -> None:
    """Write one run's rows in place of any that the run has written before.

    The rows' partitions hold the run's name, so replacing partitions never
    touches another run's rows. ``rebalance`` as for :func:`write_rows`.
    """
    guard_schema(rows, target, partition_by)
    spark, rows = rows.sparkSession, rows.hint("rebalance") if rebalance else rows
    with tables.compiled(spark):
        if "/" in target:
            w = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
            w.parquet(target)
        elif tables.table_exists(spark, target):
            with tables.setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                rows.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        else:
            rows.write.format("parquet").partitionBy(*partition_by).saveAsTable(target)


def rejects_of(target: str) -> str:
    """Where the rows of sheets that are not accepted go: beside the raw table."""
    return target.rstrip("/") + "_rejects"


@dataclass
class Loaded:
    """One run's rows, written, and what became of the others."""

    rows: int
    sheet_rows: int
    blank_rows: int
    rejected_rows: int
    rejected: dict[str, int]  # sheets that were not accepted, by reason
    report: DataFrame  # the sheet report (stored)
    report_folder: str


def load_cells(
    cells: DataFrame, positions: Sequence[int], names: Sequence[str], target: str, run: str, run_date=None, note: str = "",
    rebalance: bool = True,
) -> Loaded:
    """Judge the sheets, write the rows of the accepted ones and, apart, those of the others.

    The sheet report takes a pass of its own over the cells that reads no
    values; rows are neither shuffled nor sorted for it. Without ``rebalance`` (cells
    that Spark scans from files) they are not shuffled for the table either: the scan
    packs small files into splits, and a split becomes a file.
    """
    spark = cells.sparkSession
    folder = scratch_dir(spark, "sheets")
    sheets.sheet_report(cells, positions).write.mode("overwrite").parquet(folder)
    report = spark.read.parquet(folder)
    bad = report.filter(~F.col("accepted"))
    seen, kept = Observation(f"sheets{note}"), Observation(f"rows{note}")
    data = F.col("row_no") > 0
    watched = sheets.judged(cells, report).observe(
        seen,
        F.count_if(data).alias("sheet_rows"),
        F.count_if(data & ~F.col("accepted")).alias("rejected_rows"),
    )
    stamped = [] if run_date is None else ["load_date"]
    rows = wb.to_rows(watched, positions, names, run_date, arrival=True).withColumn(RUN_COL, F.lit(run))
    with nullcontext() if rebalance else tables.at_most(spark, "spark.sql.files.maxPartitionBytes", SPLIT_BYTES):
        write_run(rows.observe(kept, F.count(F.lit(1)).alias("rows")), target, [*stamped, RUN_COL], rebalance)
    n = observed(kept, lambda: {"rows": 0})["rows"]
    s = observed(seen, lambda: {"sheet_rows": 0, "rejected_rows": 0})
    rejected = {r.reason: r.n for r in bad.groupBy(sheets.reason().alias("reason")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if rejected:
        out = sheets.rejected_rows(cells, report).withColumn(RUN_COL, F.lit(run))
        if run_date is not None:
            out = out.withColumn("load_date", F.lit(str(run_date)).cast("date"))
        write_run(out, rejects_of(target), [*stamped, RUN_COL])
    return Loaded(n, s["sheet_rows"], s["sheet_rows"] - s["rejected_rows"] - n, s["rejected_rows"], rejected, report, folder)


def ingest_cells(
    cells: DataFrame, positions: Sequence[int], names: Sequence[str], target: str, run_date, run: str | None = None,
    rebalance: bool = True,
) -> IngestResult:
    """Load the picked columns of any frame of sheet cells (path, sheet,
    sheet_no, row_no, width, cells) with lineage, place in the file, load date
    and run; report the counts of this run alone."""
    spark, run = cells.sparkSession, run or new_run()
    got = load_cells(cells, positions, names, target, run, run_date, rebalance=rebalance)
    tables.remove_folder(spark, got.report_folder)
    if got.rows == 0:
        raise NothingToIngest("no row could be loaded")
    return _result(spark, got, target, run, run_date)


def _result(spark: SparkSession, got: Loaded, target: str, run: str, run_date) -> IngestResult:
    own = read_target(spark, target).filter(
        (F.col("load_date") == F.lit(str(run_date)).cast("date")) & (F.col(RUN_COL) == run)
    )
    report = own.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))
    return IngestResult(
        got.rows, got.sheet_rows, got.blank_rows, got.rejected_rows,
        got.rejected.get(sheets.NARROW, 0), got.rejected.get(sheets.UNREADABLE, 0), report, [], run, str(run_date),
    )


def staged_cells(cells: DataFrame) -> tuple[DataFrame, str]:
    """Cells of a parser, stored, so that the sheet report does not parse the files a second time."""
    folder = scratch_dir(cells.sparkSession, "cells")
    cells.write.mode("overwrite").parquet(folder)
    return cells.sparkSession.read.schema(cells.schema).parquet(folder), folder


def ingest(
    spark: SparkSession,
    inbox: str | Sequence[str],
    positions: Sequence[int],
    names: Sequence[str],
    target: str,
    run_date,
    pattern: str = "*.xlsx",
) -> IngestResult:
    """Ingest every workbook of the inbox; ``loaded_files`` are this run's."""
    files = list_files(spark, inbox if isinstance(inbox, str) else list(inbox), pattern)
    if files is None or files.isEmpty():
        raise NothingToIngest(f"no {pattern} file in {inbox}")
    result, _ = load_workbooks(spark, files, positions, names, target, run_date, new_run())
    if result.rows == 0:
        raise NothingToIngest("no row could be loaded")
    return result


def load_workbooks(
    spark: SparkSession, files: DataFrame, positions: Sequence[int], names: Sequence[str], target: str, run_date, run: str
) -> tuple[IngestResult, list[str]]:
    """Load the listed workbooks (path, size, modified) as one run; the result, and the paths that need no second try."""
    # Paths are listing metadata (Spark's file index holds them on the driver already).
    paths = sorted(r.path for r in files.select("path").distinct().collect())
    listed = wb.list_workbooks(spark, paths)
    cells, folder = staged_cells(wb.scan_cells(listed, by_path=wb.workers_can_open(listed)))
    got = load_cells(cells, positions, names, target, run, run_date)
    by_path = got.report.groupBy("path").agg(
        F.bool_or("accepted").alias("loaded"), F.every(F.col("problem").isNull()).alias("read")
    )
    outcome = by_path.filter("loaded or read").collect()
    result = _result(spark, got, target, run, run_date)
    result.loaded_files = sorted(r.path for r in outcome if r.loaded)
    tables.remove_folder(spark, folder)
    tables.remove_folder(spark, got.report_folder)
    return result, [r.path for r in outcome]


def load_drop(
    spark: SparkSession, inbox: str, files: DataFrame, positions: Sequence[int], names: Sequence[str], target: str, run_date, run: str
) -> IngestResult:
    """Load the listed part files of a drop as one run."""
    paths = sorted(r.path for r in files.select("path").distinct().collect())
    result = ingest_cells(drops.read_drop(spark, inbox, paths), positions, names, target, run_date, run, rebalance=False)
    result.loaded_files = paths
    return result


def ingest_pending(
    spark: SparkSession,
    manifest: Manifest,
    source: str,
    inbox: str,
    positions: Sequence[int],
    names: Sequence[str],
    target: str,
    run_date,
    drop: bool = False,
    pattern: str = "*.xlsx",
) -> list[IngestResult]:
    """Load the files of an inbox that the manifest does not have; one result per run.

    Runs that died come first, under their own name and date. A workbook in
    which nothing could be read stays pending; one that was read but had no
    sheet wide enough is done (its rows are in the reject table). An inbox
    that is missing is an empty one.
    """

    def load(files: DataFrame, run: str, date) -> IngestResult | None:
        if drop:
            try:
                got = load_drop(spark, inbox, files, positions, names, target, date, run)
            except NothingToIngest:
                got = None
        else:
            got, handled = load_workbooks(spark, files, positions, names, target, date, run)
            files = files.join(spark.createDataFrame([(p,) for p in handled], "path string"), "path", "left_semi")
        manifest.finish(files, source, run, date)
        return got if got and got.rows else None

    done = [load(manifest.claimed(source, run), run, date) for run, date in manifest.unfinished(source)]
    listed = list_files(spark, inbox, None if drop else pattern, deep=drop)
    files = None if listed is None else manifest.pending(listed, source)
    if files is not None and not files.isEmpty():
        run = new_run()
        manifest.claim(files, source, run, run_date)
        done.append(load(manifest.claimed(source, run), run, run_date))
    results = [r for r in done if r is not None]
    if not results:
        raise NothingToIngest(f"nothing new in {inbox}")
    return results


def archive(spark: SparkSession, paths: Sequence[str], folder: str, run: str, threads: int = 16, parents: bool = False) -> int:
    """Move ingested files into the run's own folder under ``folder`` (renames
    on the files' own file system, several at a time), so that a later file of
    the same name never meets an earlier one; with ``parents`` each keeps its
    own folder's name (part files of a drop). Raises if a file stays behind.
    Call only after the append succeeded."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    dst_dir = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{run}")

    def move(path: str) -> bool:
        src = jvm.org.apache.hadoop.fs.Path(path)
        fs = src.getFileSystem(conf)
        own_dir = jvm.org.apache.hadoop.fs.Path(dst_dir, src.getParent().getName()) if parents else dst_dir
        try:
            if parents:
                fs.mkdirs(own_dir)
            return fs.rename(src, jvm.org.apache.hadoop.fs.Path(own_dir, src.getName()))
        except Py4JJavaError:  # some file systems say no by an exception
            return False

    if paths:
        dst_dir.getFileSystem(conf).mkdirs(dst_dir)
    with ThreadPoolExecutor(threads) as pool:
        left = [p for p, moved in zip(paths, pool.map(move, paths)) if not moved]
    if left:
        raise RuntimeError(f"{len(left)} loaded files could not be moved to {dst_dir}: {left[:5]}")
    return len(paths)

"""Incremental ingest: each file of an inbox is loaded exactly once.

The streaming file source remembers in its checkpoint which files it has
already handed out, so re-running picks up only new drops
(``trigger(availableNow=True)`` processes what is there and stops). Each
micro-batch is written to its own ``ingest_run`` partition with dynamic
partition overwrite, and its run's name and load date are noted before the write, so a batch
replayed after a failure, on whatever day, replaces its own earlier output
instead of appending twice. Names are those of batch runs, with the epoch behind:
they sort by time among all runs, and no two checkpoints share one.

With a manifest (``terrace.plans.manifest``) files that a batch run, or another
stream, has loaded are left out, and loaded ones are noted there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.plans.bronze import load_cells, new_run, staged_cells
from terrace.plans.manifest import Manifest
from terrace.sources import drops, tables
from terrace.sources import workbooks as wb

# The binaryFile source's fixed schema (a streaming source needs it stated).
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


@dataclass
class IncrementalResult:
    batches: int  # micro-batches run (0: nothing new)
    rows: int  # rows appended by them
    dates: list[str] = field(default_factory=list)  # load dates that got rows (a replayed batch keeps its first)


@dataclass
class Noted:
    """How a stream's files are known to a manifest: ``columns`` give path, size and modification time of a batch's rows."""

    manifest: Manifest
    source: str
    columns: tuple[str, str, str]

    def new_rows(self, batch: DataFrame, run: str) -> DataFrame:
        """Rows of files that no other run has loaded."""
        named = [F.col(c).alias(n) for c, n in zip(self.columns, ("path", "size", "modified"))]
        files = self.manifest.pending(batch.select(*named).distinct(), self.source, run)
        key = [F.col(f"_new.{n}").eqNullSafe(F.col(f"_row.{c}")) for c, n in zip(self.columns, ("path", "size", "modified"))]
        return batch.alias("_row").join(files.alias("_new"), key, "left_semi")

    def finish(self, batch: DataFrame, run: str, date) -> None:
        named = [F.col(c).alias(n) for c, n in zip(self.columns, ("path", "size", "modified"))]
        files = self.manifest.pending(batch.select(*named).distinct(), self.source, run)
        self.manifest.finish(files, self.source, run, date)


def epoch_note(spark: SparkSession, notes: str, epoch_id: int, run_date) -> tuple[str, str | None]:
    """(run name, load date) of a micro-batch: noted at its first attempt, read at replays."""
    path = f"{notes}/epoch={epoch_id}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    schema = "ingest_run string, load_date string"
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        note = (f"{new_run()}_e{epoch_id:08d}", None if run_date is None else str(run_date))
        spark.createDataFrame([note], schema).write.mode("overwrite").json(path)
    return tuple(spark.read.schema(schema).json(path).first())


def ingest_stream(
    spark: SparkSession,
    stream: DataFrame,
    cells_of: Callable[[DataFrame], DataFrame],
    positions: Sequence[int],
    names: Sequence[str],
    target: str,
    checkpoint: str,
    run_date=None,
    noted: Noted | None = None,
    parsed: bool = False,
) -> IncrementalResult:
    """Load what ``stream`` has not handed out before; ``cells_of`` makes sheet cells of a batch.

    With ``run_date`` rows are stamped and partitioned by ``load_date`` and
    then ``ingest_run``, the layout of batch ingest, so both can fill one folder.
    ``parsed``: the cells come from a parser and are stored before they are judged.
    A sheet is judged by what of it is in the micro-batch.
    """
    loaded: list[tuple[int, str | None]] = []
    notes = checkpoint.rstrip("/") + "-notes"

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        run, date = epoch_note(spark, notes, epoch_id, run_date)
        cells, folders = cells_of(noted.new_rows(batch, run) if noted else batch), []
        if parsed:
            cells, folder = staged_cells(cells)
            folders.append(folder)
        got = load_cells(cells, positions, names, target, run, date, f"_{epoch_id}")
        if noted:
            noted.finish(batch, run, date)
        for folder in [*folders, got.report_folder]:
            tables.remove_folder(spark, folder)
        loaded.append((got.rows, date))

    query = (
        stream.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return IncrementalResult(len(loaded), sum(n for n, _ in loaded), sorted({d for n, d in loaded if d and n}))


def ingest_new_files(
    spark: SparkSession,
    inbox: str,
    positions: Sequence[int],
    names: Sequence[str],
    target: str,
    checkpoint: str,
    run_date=None,
    archive_dir: str | None = None,
    max_files_per_batch: int | None = None,
    pattern: str = "*.xlsx",
    manifest: Manifest | None = None,
    source: str = "",
) -> IncrementalResult:
    """Load the workbooks not seen before.

    With ``archive_dir`` the source moves files of committed batches there
    (it does so lazily, on a later batch, so the checkpoint — not the
    folder — is the record of what was loaded).
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", pattern)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)

    def cells_of(files: DataFrame) -> DataFrame:
        # Path mode selects only ``path``, so the batch never reads the bytes.
        return wb.scan_cells(files, by_path=wb.workers_can_open(files))

    noted = Noted(manifest, source, ("path", "length", "modificationTime")) if manifest else None
    return ingest_stream(spark, reader.load(inbox), cells_of, positions, names, target, checkpoint, run_date, noted, parsed=True)


def ingest_new_drops(
    spark: SparkSession,
    inbox: str,
    positions: Sequence[int],
    names: Sequence[str],
    target: str,
    checkpoint: str,
    run_date=None,
    manifest: Manifest | None = None,
    source: str = "",
    archive_dir: str | None = None,
) -> IncrementalResult:
    """Load the part files of a JSON-lines drop that were not seen before (``archive_dir`` as for workbooks)."""
    options = {"cleanSource": "archive", "sourceArchiveDir": archive_dir} if archive_dir else None
    noted = Noted(manifest, source, ("part_path", "part_size", "part_modified")) if manifest else None
    stream = drops.stream_drop(spark, inbox, options)
    return ingest_stream(spark, stream, lambda cells: cells, positions, names, target, checkpoint, run_date, noted)

"""The record of loaded files, shared by batch and incremental ingest of every source.

A folder with two Parquet tables, both partitioned by source and run:

* ``claims``: the files a batch run is about to load, written before its rows;
* ``files``: the files it has loaded, written after them (with one line
  without a path when there was none), so a run that is there is finished.

A file is known by path, size and modification time: a file that is replaced is
loaded again. A claim without an entry in ``files`` is a run that died; its files are
loaded again under its own name and date, which replaces whatever it had
written. One run per source at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = ("path", "size", "modified")
SCHEMA = "path string, size long, modified timestamp, load_date date, source string, ingest_run string"


def missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def list_files(spark: SparkSession, inbox: str | list[str], pattern: str | None = None, deep: bool = False) -> DataFrame | None:
    """(path, size, modified) of an inbox's files, from the listing alone; None where there is no such folder."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if deep:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        found = reader.load(inbox)
    except AnalysisException as e:
        if missing(e):
            return None
        raise
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


@dataclass
class Manifest:
    spark: SparkSession
    folder: str

    def _read(self, part: str, source: str) -> DataFrame:
        """One table's lines of a source; none before the first."""
        spark = self.spark
        try:
            found = spark.read.schema(SCHEMA).parquet(f"{self.folder.rstrip('/')}/{part}")
        except AnalysisException as e:
            if not missing(e):
                raise
            found = spark.createDataFrame([], SCHEMA)
        return found.filter(F.col("source") == source)

    def _write(self, part: str, lines: DataFrame) -> None:
        """A run's lines, in place of those it may have written before it died."""
        (
            lines.select(*[c.split()[0] for c in SCHEMA.split(", ")])
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("source", "ingest_run")
            .parquet(f"{self.folder.rstrip('/')}/{part}")
        )

    def loaded(self, source: str) -> DataFrame:
        return self._read("files", source).filter(F.col("path").isNotNull())

    def pending(self, files: DataFrame, source: str, run: str | None = None) -> DataFrame:
        """``files`` that no run (but ``run``) has loaded."""
        done = self.loaded(source)
        if run is not None:
            done = done.filter(F.col("ingest_run") != run)
        return files.join(done.select(*FILE), list(FILE), "left_anti")

    def unfinished(self, source: str) -> list[tuple[str, str]]:
        """(run, load date) of claims that were never finished, oldest first."""
        finished = self._read("files", source).select("ingest_run").distinct()
        left = self._read("claims", source).join(finished, "ingest_run", "left_anti")
        rows = left.select("ingest_run", F.col("load_date").cast("string").alias("load_date")).distinct().collect()
        return sorted((r.ingest_run, r.load_date) for r in rows)

    def claimed(self, source: str, run: str) -> DataFrame:
        return self._read("claims", source).filter(F.col("ingest_run") == run).select(*FILE)

    def claim(self, files: DataFrame, source: str, run: str, load_date) -> None:
        self._write("claims", self._stamped(files, source, run, load_date))

    def finish(self, files: DataFrame, source: str, run: str, load_date) -> None:
        none = self.spark.createDataFrame([(None, None, None)], "path string, size long, modified timestamp")
        self._write("files", self._stamped(files.select(*FILE).union(none), source, run, load_date))

    @staticmethod
    def _stamped(files: DataFrame, source: str, run: str, load_date) -> DataFrame:
        date = F.lit(None if load_date is None else str(load_date)).cast("date")
        return files.select(*FILE, date.alias("load_date"), F.lit(source).alias("source"), F.lit(run).alias("ingest_run"))

"""The width guard on drops, the reject table, and the record of loaded files."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from terrace.plans import bronze, medallion, runs
from terrace.plans import catalog_queries as Q
from terrace.plans.manifest import Manifest, list_files
from terrace.sources import drops, sheets
from terrace.streaming import incremental
from tests.test_layout_runs import drop_config, put_drop, small_feeds
from tests.test_workbooks import put

DAY = "2026-01-15"


def lines(spark, rows):
    """(file, sheet, row_no, cells) lines."""
    return spark.createDataFrame(
        [(f, s, 0, n, c) for f, s, n, c in rows], "file string, sheet string, sheet_no int, row_no long, cells array<string>"
    )


def rejects(spark, raw):
    return sorted(
        (r.sheet, r.row_no, r.reason, r.cells) for r in spark.read.parquet(bronze.rejects_of(raw)).collect()
    )


def test_ragged_rows_of_a_wide_sheet_are_kept(spark, scratch):
    """Rows of 3, 1 and 0 cells in one sheet; a sheet of one cell; a sheet whose header is wide and whose rows are short."""
    rows = [
        ("f", "A", 1, ["x", "y", "z"]), ("f", "A", 2, ["w"]), ("f", "A", 3, []),
        ("f", "B", 1, ["v"]), ("f", "B", 2, None),
        ("g", "C", 0, ["h1", "h2", "h3"]), ("g", "C", 1, ["u"]),
        ("g", "D", 0, ["h1"]), ("g", "D", 1, ["a", "b", "c"]),
    ]
    drops.write_drop(lines(spark, rows), scratch + "/in")
    cells, raw = drops.read_drop(spark, scratch + "/in"), scratch + "/raw"
    res = bronze.ingest_cells(cells, [0, 1, 2], ["a", "b", "c"], raw, DAY)
    got = sorted((r.a, r.b, r.c) for r in spark.read.parquet(raw).collect())
    assert got == sorted([("x", "y", "z"), ("w", None, None), ("u", None, None)], key=str)
    assert (res.sheet_rows, res.rows, res.blank_rows, res.rejected_rows) == (7, 3, 1, 3)
    assert (res.rejected_sheets, res.unreadable) == (2, 0)
    assert rejects(spark, raw) == [("B", 1, "narrow", ["v"]), ("B", 2, "narrow", None), ("D", 1, "narrow", ["a", "b", "c"])]
    report = {r.sheet: r.accepted for r in sheets.sheet_report(cells, [0, 1, 2]).collect()}
    assert report == {"A": True, "B": False, "C": True, "D": False}


def test_unreadable_lines_are_rejected_not_lost(spark, scratch):
    drops.write_drop(lines(spark, [("f", "A", 1, ["x"])]), scratch + "/in")
    with open(scratch.replace("file:", "") + "/in/file=f/part-bad.json", "w") as fh:
        fh.write("{broken\n")
    res = bronze.ingest_cells(drops.read_drop(spark, scratch + "/in"), [0], ["a"], scratch + "/raw", DAY)
    assert (res.rows, res.unreadable) == (1, 1)
    bad = spark.read.parquet(bronze.rejects_of(scratch + "/raw")).collect()
    assert [(r.reason, r.problem, r.row_no) for r in bad] == [("unreadable", drops.BAD_LINE, -1)]


def test_partly_unreadable_workbook_sheet_is_rejected_whole(spark, scratch):
    put(scratch + "/in", "a.xlsx", [("S", [(0, [("n", "1"), ("s", "x")])]), ("T", [(0, [("n", "2")])])])
    res = bronze.ingest(spark, scratch + "/in", [0, 1], ["id", "name"], scratch + "/raw", DAY)
    assert (res.rows, res.rejected_sheets, res.rejected_rows, res.sheet_rows) == (1, 1, 1, 2)
    assert [r[2] for r in rejects(spark, scratch + "/raw")] == ["narrow"]
    assert sorted(os.listdir(scratch.replace("file:", ""))) == ["in", "raw", "raw_rejects"]


def test_a_run_done_again_replaces_its_rows(spark, scratch):
    cells = put_drop(spark, scratch + "/in", [("f", 1, "x"), ("f", 2, "y")])
    for target in (scratch + "/raw", "raw_" + uuid.uuid4().hex[:8]):
        for _ in range(2):
            bronze.ingest_cells(cells, [0], ["a"], target, DAY, run="r1")
        bronze.ingest_cells(cells, [0], ["a"], target, DAY, run="r2")
        assert bronze.read_target(spark, target).count() == 4


def pending(spark, scratch, manifest, date=DAY, source="s"):
    return bronze.ingest_pending(spark, manifest, source, scratch + "/in", [0], ["a"], scratch + "/raw", date, drop=True)


def values(spark, scratch):
    return sorted(r.a for r in spark.read.parquet(scratch + "/raw").collect())


def test_batch_runs_load_each_file_once(spark, scratch):
    manifest = Manifest(spark, scratch + "/manifest")
    with pytest.raises(bronze.NothingToIngest):  # no such inbox
        pending(spark, scratch, manifest)
    put_drop(spark, scratch + "/in", [("f", 1, "x")])
    assert [r.rows for r in pending(spark, scratch, manifest)] == [1]
    with pytest.raises(bronze.NothingToIngest):
        pending(spark, scratch, manifest)
    put_drop(spark, scratch + "/in", [("f", 1, "y")])  # a new part file of the same file
    assert [r.rows for r in pending(spark, scratch, manifest)] == [1]
    assert values(spark, scratch) == ["x", "y"]
    assert manifest.loaded("s").count() == 2 and manifest.loaded("other").count() == 0


def test_a_run_that_died_is_done_again_under_its_name_and_date(spark, scratch, monkeypatch):
    manifest = Manifest(spark, scratch + "/manifest")
    put_drop(spark, scratch + "/in", [("f", 1, "x")])
    finish = Manifest.finish
    monkeypatch.setattr(Manifest, "finish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):  # after the rows were written
        pending(spark, scratch, manifest)
    monkeypatch.setattr(Manifest, "finish", finish)
    put_drop(spark, scratch + "/in", [("f", 2, "y")])
    again, new = pending(spark, scratch, manifest, "2026-01-16")
    assert (again.load_date, new.load_date) == (DAY, "2026-01-16") and again.run < new.run
    assert values(spark, scratch) == ["x", "y"]
    assert manifest.unfinished("s") == []


def test_unreadable_workbooks_stay_pending(spark, scratch):
    manifest, inbox = Manifest(spark, scratch + "/manifest"), scratch + "/in"
    put(inbox, "a.xlsx", [("S", [(0, [("n", "1"), ("n", "2")])])])
    put(inbox, "narrow.xlsx", [("S", [(0, [("n", "1")])])])
    with open(inbox.replace("file:", "") + "/broken.xlsx", "wb") as fh:
        fh.write(b"broken")
    args = (spark, manifest, "s", inbox, [0, 1], ["a", "b"], scratch + "/raw", DAY)
    (res,) = bronze.ingest_pending(*args)
    assert (res.rows, res.rejected_sheets, res.unreadable) == (1, 1, 1)
    left = manifest.pending(list_files(spark, inbox), "s").collect()
    assert [os.path.basename(r.path) for r in left] == ["broken.xlsx"]
    with pytest.raises(bronze.NothingToIngest):
        bronze.ingest_pending(*args)


def test_two_streams_and_batches_into_one_table(spark, scratch):
    """Streams with checkpoints of their own keep both rows; later runs sort behind earlier ones, whatever their kind."""
    raw, manifest = scratch + "/raw", Manifest(spark, scratch + "/manifest")
    for name in ("a", "b"):
        put_drop(spark, f"{scratch}/{name}", [("f", 1, name)])
        res = incremental.ingest_new_drops(spark, f"{scratch}/{name}", [0], ["a"], raw, f"{scratch}/ck-{name}", DAY, manifest, "s")
        assert res.rows == 1
    put_drop(spark, scratch + "/in", [("f", 1, "c")])
    pending(spark, scratch, manifest)
    put_drop(spark, scratch + "/a", [("f", 2, "d")])
    incremental.ingest_new_drops(spark, scratch + "/a", [0], ["a"], raw, scratch + "/ck-a", DAY, manifest, "s")
    got = [r.a for r in spark.read.parquet(raw).orderBy(bronze.RUN_COL).collect()]
    assert got == ["a", "b", "c", "d"]
    # a checkpoint that is lost: the manifest still knows the files
    res = incremental.ingest_new_drops(spark, scratch + "/a", [0], ["a"], raw, scratch + "/ck-new", DAY, manifest, "s")
    assert res.rows == 0 and spark.read.parquet(raw).count() == 4
    # and a batch run does not load what a stream has
    with pytest.raises(bronze.NothingToIngest):
        bronze.ingest_pending(spark, manifest, "s", scratch + "/a", [0], ["a"], raw, DAY, drop=True)


def test_streamed_workbooks_and_batch_share_the_record(spark, scratch):
    manifest, inbox, raw = Manifest(spark, scratch + "/manifest"), scratch + "/in", scratch + "/raw"
    put(inbox, "a b+c.xlsx", [("S", [(0, [("n", "1")])])])
    args = (inbox, [0], ["a"], raw)
    assert incremental.ingest_new_files(spark, *args, scratch + "/ck", DAY, manifest=manifest, source="s").rows == 1
    with pytest.raises(bronze.NothingToIngest):
        bronze.ingest_pending(spark, manifest, "s", *args, DAY)
    put_drop(spark, scratch + "/in2", [("name with + and %", 1, "x")])
    incremental.ingest_new_drops(spark, scratch + "/in2", [0], ["a"], raw, scratch + "/ck2", DAY, manifest, "t")
    with pytest.raises(bronze.NothingToIngest):
        bronze.ingest_pending(spark, manifest, "t", scratch + "/in2", [0], ["a"], raw, DAY, drop=True)


def test_whole_run_over_drops_loads_once_and_archives(spark, scratch):
    m_raw, h_raw = small_feeds(spark)
    cfg = drop_config(scratch, members_processed=scratch + "/done/m", holders_processed=None)
    Q.feed_drop(m_raw, medallion.MEMBERS, cfg.members_inbox)
    out = runs.run_all(spark, cfg, DAY)  # the holders' inbox is missing
    assert out.raw_rows == {"members": m_raw.count(), "holders": 0} and out.gold_version is None
    left = [f for _, _, fs in os.walk(cfg.members_inbox.replace("file:", "")) for f in fs if f.endswith(".json")]
    done = [f for _, _, fs in os.walk(cfg.members_processed.replace("file:", "")) for f in fs if f.endswith(".json")]
    assert left == [] and done
    Q.feed_drop(h_raw, medallion.HOLDERS, cfg.holders_inbox)
    out = runs.run_all(spark, cfg, DAY)
    assert out.raw_rows == {"members": 0, "holders": h_raw.count()} and out.gold_version
    with pytest.raises(runs.NoNewRows):  # holders are still in their inbox, and known
        runs.run_all(spark, cfg, DAY)
    assert spark.read.parquet(cfg.members_raw).count() == m_raw.count()
    assert spark.read.parquet(cfg.holders_raw).filter(F.col("load_date") == DAY).count() == h_raw.count()

"""Workbook source: parsing details, faults, ingest, incremental ingest."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from terrace.plans import bronze
from terrace.sources import workbooks as wb
from terrace.sources.workbook_writer import build_workbook, cell, write_workbooks
from terrace.streaming import incremental


def put(folder, name, sheets):
    path = folder.replace("file:", "")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "wb") as fh:
        fh.write(build_workbook(sheets))


def parsed(spark, folder):
    return sorted(
        (r.sheet, r.row_no, tuple(r.cells) if r.cells is not None else None, r.problem is not None)
        for r in wb.read_workbooks(spark, folder).collect()
    )


def test_cells_gaps_types_and_blank_rows(spark, scratch):
    put(scratch, "a.xlsx", [
        ("S1", [(0, [("s", "x"), None, ("n", "7"), ("d", "2024-01-15")]),
                (2, []),
                (3, [("i", " pad "), ("n", "1.5")])]),
    ])
    got = parsed(spark, scratch)
    assert got == [
        ("S1", 0, ("C0", "C1", "C2", "C3"), False),
        ("S1", 1, ("x", None, "7", "2024-01-15"), False),
        ("S1", 3, (), False),
        ("S1", 4, (" pad ", "1.5"), False),
    ]


def test_corrupt_and_other_files(spark, scratch):
    path = scratch.replace("file:", "")
    with open(os.path.join(path, "bad.xlsx"), "wb") as fh:
        fh.write(b"not a zip")
    with open(os.path.join(path, "notes.txt"), "w") as fh:
        fh.write("ignored")
    put(scratch, "ok.xlsx", [("S", [(0, [("n", "1")])])])
    rows = wb.read_workbooks(spark, scratch).collect()
    assert {r.path.rsplit("/", 1)[-1] for r in rows} == {"bad.xlsx", "ok.xlsx"}
    bad = [r for r in rows if r.path.endswith("bad.xlsx")]
    assert len(bad) == 1 and bad[0].row_no == -1 and "BadZipFile" in bad[0].problem


def test_short_sheet_rejected(spark, scratch):
    put(scratch, "a.xlsx", [("wide", [(0, [("n", str(i)) for i in range(8)])]), ("short", [(0, [("n", "1")] * 3)])])
    cells = wb.read_workbooks(spark, scratch)
    rep = {r.sheet: (r.width, r.data_rows, r.accepted) for r in wb.sheet_report(cells, [1, 7]).collect()}
    assert rep == {"wide": (8, 1, True), "short": (3, 1, False)}
    out = wb.to_rows(cells, [1, 7], ["a", "b"]).collect()
    assert [(r.a, r.b) for r in out] == [("1", "7")]


def test_shared_strings_and_trim(spark, scratch):
    put(scratch, "a.xlsx", [("S", [(0, [("s", " same "), ("s", "same"), ("i", "\tinline\n")])])])
    out = wb.to_rows(wb.read_workbooks(spark, scratch), [0, 1, 2], ["a", "b", "c"]).collect()
    assert [(r.a, r.b, r.c, r.source_file) for r in out] == [("same", "same", "inline", "./" + scratch.rsplit("/", 1)[-1] + "/a.xlsx")]


def test_sheets_in_any_order_same_rows(spark, scratch):
    df = spark.range(40).select(
        F.lit("f.xlsx").alias("file"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("sheet"),
        F.col("id").alias("row_no"), F.array(cell("n", F.col("id")), cell("s", F.lit("v"))).alias("cells"))
    write_workbooks(df, scratch + "/in").collect()
    out = wb.to_rows(wb.read_workbooks(spark, scratch + "/in"), [0, 1], ["id", "v"])
    assert sorted(int(r.id) for r in out.collect()) == list(range(40))


def test_empty_inbox_raises(spark, scratch):
    os.makedirs(scratch.replace("file:", "") + "/empty", exist_ok=True)
    with pytest.raises(bronze.NothingToIngest):
        bronze.ingest(spark, scratch + "/empty", [0], ["a"], scratch + "/bronze", "2026-01-15")


def test_ingest_appends_with_counts(spark, scratch):
    put(scratch + "/in", "a.xlsx", [("S", [(0, [("n", "1"), ("s", "x")]), (1, []), (2, [("n", "2"), ("s", "y")])])])
    put(scratch + "/in", "b.xlsx", [("S", [(0, [("n", "3")])])])  # too narrow for position 1
    res = bronze.ingest(spark, scratch + "/in", [0, 1], ["id", "name"], scratch + "/bronze", "2026-01-15")
    assert (res.rows, res.rejected_sheets) == (2, 1)
    assert sorted(tuple(r) for r in res.report.collect()) == [("./in/a.xlsx", 2)]
    got = spark.read.parquet(scratch + "/bronze").select("id", "name", F.col("load_date").cast("string")).collect()
    assert sorted(tuple(r) for r in got) == [("1", "x", "2026-01-15"), ("2", "y", "2026-01-15")]


def test_incremental_twice_is_once(spark, scratch):
    inbox, tgt, ck = scratch + "/in", scratch + "/bronze", scratch + "/ck"
    put(inbox, "a.xlsx", [("S", [(0, [("n", "1")])])])
    assert incremental.ingest_new_files(spark, inbox, [0], ["id"], tgt, ck).batches == 1
    assert incremental.ingest_new_files(spark, inbox, [0], ["id"], tgt, ck).batches == 0  # nothing new
    put(inbox, "b.xlsx", [("S", [(0, [("n", "2")]), (1, [("n", "3")])])])
    res = incremental.ingest_new_files(spark, inbox, [0], ["id"], tgt, ck)
    assert (res.batches, res.rows) == (1, 2)
    assert sorted(r.id for r in spark.read.parquet(tgt).collect()) == ["1", "2", "3"]


def test_serial_dates():
    assert wb.serial_to_text(45306) == "2024-01-15"
    assert wb.serial_to_text(45306.5) == "2024-01-15 12:00:00"
    assert wb.serial_to_text(1) == "1900-01-01"


def test_zip_members_read_lazily(spark, scratch):
    # A workbook whose sheet part is missing: the sheet is reported, not fatal.
    data = build_workbook([("S", [(0, [("n", "1")])])])
    import io
    src = zipfile.ZipFile(io.BytesIO(data))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as dst:
        for n in src.namelist():
            if not n.startswith("xl/worksheets/"):
                dst.writestr(n, src.read(n))
    os.makedirs(scratch.replace("file:", ""), exist_ok=True)
    with open(scratch.replace("file:", "") + "/m.xlsx", "wb") as fh:
        fh.write(buf.getvalue())
    rows = wb.read_workbooks(spark, scratch).collect()
    assert len(rows) >= 1 and any(r.problem for r in rows)


def test_incremental_archive_moves_committed_files(spark, scratch):
    inbox, tgt, ck, arc = scratch + "/in", scratch + "/bronze", scratch + "/ck", scratch + "/archive"
    put(inbox, "a.xlsx", [("S", [(0, [("n", "1")])])])
    incremental.ingest_new_files(spark, inbox, [0], ["id"], tgt, ck, archive_dir=arc)
    put(inbox, "b.xlsx", [("S", [(0, [("n", "2")])])])
    incremental.ingest_new_files(spark, inbox, [0], ["id"], tgt, ck, archive_dir=arc)
    assert sorted(r.id for r in spark.read.parquet(tgt).collect()) == ["1", "2"]
    archived = [os.path.basename(f) for _, _, fs in os.walk(arc.replace("file:", "")) for f in fs]
    # Files of committed batches move once a later batch runs; never a file
    # that has not been loaded.
    assert "a.xlsx" in archived and set(archived) <= {"a.xlsx", "b.xlsx"}


def test_path_and_content_modes_agree(spark, scratch):
    put(scratch, "a.xlsx", [("S1", [(0, [("s", "x"), None, ("n", "7"), ("d", "2024-01-15")])]),
                            ("S2", [(3, [("i", "y")])])])
    files = wb.list_workbooks(spark, scratch)
    by_path = sorted(tuple(map(str, r)) for r in wb.scan_cells(files, by_path=True).collect())
    by_bytes = sorted(tuple(map(str, r)) for r in wb.scan_cells(files, by_path=False).collect())
    assert by_path == by_bytes and len(by_path) == 4
    assert wb.workers_can_open(files)
    elsewhere = spark.createDataFrame([("hdfs://n/in/a.xlsx",), ("file:/in/b.xlsx",)], "path string")
    assert not wb.workers_can_open(elsewhere)
    assert wb.local_path("file:///a/b.xlsx") == "/a/b.xlsx" and wb.local_path("file:/a/b.xlsx") == "/a/b.xlsx"


def test_connector_style_flags(spark, scratch):
    # Header on, values untrimmed, empty text as NULL, all-NULL rows dropped.
    put(scratch, "a.xlsx", [("S", [(0, [("i", " pad "), ("i", "")]), (1, [("i", ""), ("i", "")]), (2, [("n", "3")])])])
    out = wb.to_rows(wb.read_workbooks(spark, scratch), [0, 1], ["a", "b"], trim=False, blank_as_null=True)
    assert sorted((r.a, r.b) for r in out.collect()) == [(" pad ", None), ("3", None)]


def test_per_sheet_split_agrees_with_per_file(spark, scratch):
    put(scratch, "a.xlsx", [(f"S{i}", [(r, [("n", str(i * 100 + r)), ("s", "v")]) for r in range(5)]) for i in range(6)])
    path = scratch.replace("file:", "")
    with open(path + "/bad.xlsx", "wb") as fh:
        fh.write(b"nope")
    files = wb.list_workbooks(spark, scratch)
    split = sorted(tuple(map(str, r)) for r in wb.scan_cells(files, by_path=True, per_sheet=True).collect())
    whole = sorted(tuple(map(str, r)) for r in wb.scan_cells(files, by_path=True, per_sheet=False).collect())
    assert split == whole and len(split) == 6 * 6 + 1


def test_ingest_writes_few_files(spark, scratch):
    from terrace.operators.layout import file_count

    for i in range(12):
        put(scratch + "/in", f"f{i}.xlsx", [("S", [(r, [("n", str(i * 10 + r)), ("s", "v")]) for r in range(5)])])
    res = bronze.ingest(spark, scratch + "/in", [0, 1], ["id", "v"], scratch + "/raw", "2026-01-15")
    assert res.rows == 60
    assert file_count(spark, scratch + "/raw") <= 2  # not one per parse task

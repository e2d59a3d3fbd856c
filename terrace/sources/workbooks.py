"""Spreadsheet (.xlsx) workbooks as a Spark source.

``binaryFile`` lists the inbox (Spark packs small files into one task up to
``spark.sql.files.maxPartitionBytes``) and ``mapInPandas`` parses workbooks
on the executors with the standard library: zip members read lazily, sheet
XML streamed through expat handlers that build rows directly. Each sheet
row becomes one output row with an array of cell texts. Everything after
that — picking columns by position, trimming, the width guard, lineage, the
load stamp — is ordinary Spark expressions.

Two ways to reach the files: for inboxes on a local or mounted file system
only paths travel and the work is split per sheet (a cheap pass lists the
sheets); for other file systems the bytes travel in the ``content`` column
and a workbook is parsed by one task.

Row layout of a parsed workbook (``CELL_SCHEMA``):

* ``row_no = 0``: the sheet's header row; ``width`` is its cell count.
* ``row_no >= 1``: data rows, numbered from the header (rows absent from the
  file leave gaps in the numbering); ``width`` repeats the header's.
* ``row_no = -1``: the file or sheet could not be read; ``problem`` says why.

A single sheet is parsed by one task (a zip member cannot be split), but
rows stream out in bounded batches, so memory stays flat however long the
sheet is.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce
from xml.etree.ElementTree import iterparse
from xml.parsers import expat

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.columns import stamp_date, strip_space
from terrace.operators.frames import cells_by_position, lineage
from terrace.sources.sheets import judged, sheet_report

# The functions Spark runs on executors live in this module; send them by
# value so workers need not have the package installed (no --py-files).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL_SCHEMA = (
    "path string, sheet string, sheet_no int, row_no int, width int, cells array<string>, problem string"
)
BATCH_ROWS = 10_000

_NS_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_NS_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_NS_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"
# Built-in number formats that render as dates or times.
_DATE_BUILTINS = set(range(14, 23)) | {45, 46, 47}
_DATE_TOKENS = re.compile(r"[dmyhs]", re.I)
_QUOTED = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')


def _col_index(ref: str) -> int:
    """``'C5'`` → 2 (0-based column of a cell reference)."""
    n = 0
    for ch in ref:
        if "A" <= ch <= "Z":
            n = n * 26 + (ord(ch) - 64)
        elif "a" <= ch <= "z":
            n = n * 26 + (ord(ch) - 96)
        else:
            break
    return n - 1


def _text_of(elem) -> str:
    """Text of a shared or inline string: a plain ``<t>``, or the ``<t>`` of
    each rich-text run (phonetic ``<rPh>`` runs are not part of the value)."""
    runs = elem.findall(_NS_MAIN + "r")
    if not runs:
        return elem.findtext(_NS_MAIN + "t") or ""
    return "".join(r.findtext(_NS_MAIN + "t") or "" for r in runs)


def _read_xml(zf: zipfile.ZipFile, name: str):
    from xml.etree.ElementTree import fromstring

    return fromstring(zf.read(name))


def _sheets(zf: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, zip member) in workbook order."""
    wb = _read_xml(zf, "xl/workbook.xml")
    rels = _read_xml(zf, "xl/_rels/workbook.xml.rels")
    targets = {r.get("Id"): r.get("Target") for r in rels.iter(_NS_PKG + "Relationship")}
    out = []
    for s in wb.iter(_NS_MAIN + "sheet"):
        target = targets.get(s.get(_NS_REL + "id"), "")
        member = target.lstrip("/") if target.startswith("/") else "xl/" + target
        out.append((s.get("name"), member))
    return out


def _date_styles(zf: zipfile.ZipFile) -> set[int]:
    """Indices of cell styles whose number format shows a date."""
    if "xl/styles.xml" not in zf.namelist():
        return set()
    st = _read_xml(zf, "xl/styles.xml")
    custom = {}
    for nf in st.iter(_NS_MAIN + "numFmt"):
        code = _QUOTED.sub("", nf.get("formatCode", ""))
        custom[int(nf.get("numFmtId"))] = bool(_DATE_TOKENS.search(code))
    out = set()
    xfs = st.find(_NS_MAIN + "cellXfs")
    if xfs is None:
        return out
    for i, xf in enumerate(xfs.findall(_NS_MAIN + "xf")):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _DATE_BUILTINS or custom.get(fid, False):
            out.add(i)
    return out


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in zf.namelist():
        return []
    out = []
    with zf.open("xl/sharedStrings.xml") as fh:
        root = None
        for event, elem in iterparse(fh, events=("start", "end")):
            if root is None:
                root = elem
            if event == "end" and elem.tag == _NS_MAIN + "si":
                out.append(_text_of(elem))
                root.clear()  # drop processed entries, not just their content
    return out


def _date1904(zf: zipfile.ZipFile) -> bool:
    wb = _read_xml(zf, "xl/workbook.xml")
    pr = wb.find(_NS_MAIN + "workbookPr")
    return pr is not None and pr.get("date1904", "0") in ("1", "true")


def serial_to_text(serial: float, date1904: bool = False) -> str:
    """Spreadsheet day number → ISO date (``yyyy-mm-dd``), with the time when
    the day is not whole."""
    base = _dt.datetime(1904, 1, 1) if date1904 else _dt.datetime(1899, 12, 30)
    if not date1904 and serial < 61:
        serial += 1  # the 1900 system counts a 29 Feb 1900 that never was
    ts = base + _dt.timedelta(days=serial)
    ts = ts.replace(microsecond=0) if ts.microsecond < 500_000 else (ts + _dt.timedelta(seconds=1)).replace(microsecond=0)
    return ts.date().isoformat() if ts.time() == _dt.time(0) else ts.isoformat(sep=" ")


_LETTERS: dict[str, int] = {}
_READ_BYTES = 1 << 16


def _letters_index(ref: str) -> int:
    """0-based column of a cell reference, cached per column letters."""
    letters = ref.rstrip("0123456789")
    idx = _LETTERS.get(letters)
    if idx is None:
        idx = _LETTERS[letters] = _col_index(letters)
    return idx


class _SheetTarget:
    """Expat handlers that turn a sheet's XML straight into row lists.

    No element tree is built: each finished ``<row>`` lands in ``done`` as
    ``(row number, cells)``. Tags are matched by local name, so a prefixed
    spelling (``x:c``) reads the same as the default-namespace one.
    """

    def __init__(self, shared: list[str], date_styles: set[int], date1904: bool):
        self.shared, self.date_styles, self.date1904 = shared, date_styles, date1904
        self.done: list[tuple[int, list[str | None]]] = []
        self.next_row = 1
        self.row = 0
        self.cells: list[str | None] = []
        self.pos = 0
        self.kind = "n"
        self.style = 0
        self.buf: list[str] = []
        self.take = False  # inside <v>, or a <t> of an inline string
        self.inline = False
        self.phonetic = False

    def start(self, tag, attrib):
        if ":" in tag:
            tag = tag.rpartition(":")[2]
        if tag == "c":
            ref = attrib.get("r")
            if ref:
                self.pos = _letters_index(ref)
            self.kind = attrib.get("t", "n")
            self.style = int(attrib.get("s", "0"))
            self.buf = []
            self.inline = False
        elif tag == "v":
            self.take = True
        elif tag == "t":
            self.take = not self.phonetic
        elif tag == "is":
            self.inline = True
        elif tag == "rPh":
            self.phonetic = True
        elif tag == "row":
            self.row = int(attrib.get("r", self.next_row))
            self.cells = []
            self.pos = 0

    def data(self, text):
        if self.take:
            self.buf.append(text)

    def end(self, tag):
        if ":" in tag:
            tag = tag.rpartition(":")[2]
        if tag == "v" or tag == "t":
            self.take = False
        elif tag == "c":
            cells = self.cells
            while len(cells) < self.pos:
                cells.append(None)
            cells.append(self._value())
            self.pos += 1
        elif tag == "row":
            cells = self.cells
            while cells and cells[-1] is None:
                cells.pop()
            self.done.append((self.row, cells))
            self.next_row = self.row + 1
        elif tag == "rPh":
            self.phonetic = False

    def _value(self) -> str | None:
        kind = self.kind
        if kind == "inlineStr":
            return "".join(self.buf) if self.inline else None
        if not self.buf:
            return None
        raw = "".join(self.buf)
        if kind == "s":
            return self.shared[int(raw)]
        if kind == "b":
            return "true" if raw.strip() in ("1", "true") else "false"
        if kind == "e":
            return None
        if kind == "n" and self.style in self.date_styles:
            try:
                return serial_to_text(float(raw), self.date1904)
            except ValueError:
                return raw
        return raw


def _sheet_rows(zf, member, shared, date_styles, date1904) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells) of one sheet in order. Missing cells come out as
    None, so a gap never shifts later cells left; rows absent from the file
    are not generated (a sheet may jump from row 2 to row 1,000,000). The
    member is read in 64 KB chunks and no tree is kept, so memory is flat."""
    target = _SheetTarget(shared, date_styles, date1904)
    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler = target.start
    parser.EndElementHandler = target.end
    parser.CharacterDataHandler = target.data
    with zf.open(member) as fh:
        while chunk := fh.read(_READ_BYTES):
            parser.Parse(chunk, False)
            if target.done:
                yield from target.done
                target.done = []
    parser.Parse(b"", True)
    yield from target.done


_COLS = ["path", "sheet", "sheet_no", "row_no", "width", "cells", "problem"]


def _problem(path: str, sheet=None, sheet_no=None, width=None, err: Exception | None = None) -> list:
    return [path, sheet, sheet_no, -1, width, None, f"{type(err).__name__}: {err}"]


def _parse_sheet(zf, path, name, sheet_no, member, shared, styles, d1904) -> Iterator[pd.DataFrame]:
    """One sheet as ``CELL_SCHEMA`` frames of at most ``BATCH_ROWS`` rows."""
    buf = []
    width = None
    first = 0
    try:
        for r, cells in _sheet_rows(zf, member, shared, styles, d1904):
            if width is None:  # the first row present is the header
                if not cells:
                    continue
                width, first = len(cells), r
                buf.append([path, name, sheet_no, 0, width, cells, None])
                continue
            buf.append([path, name, sheet_no, r - first, width, cells, None])
            if len(buf) >= BATCH_ROWS:
                yield pd.DataFrame(buf, columns=_COLS)
                buf = []
    except Exception as e:  # noqa: BLE001 - a bad sheet is reported, the rest still load
        buf.append(_problem(path, name, sheet_no, width, e))
    if width is None:  # empty sheet: header row of width 0
        buf.append([path, name, sheet_no, 0, 0, [], None])
    if buf:
        yield pd.DataFrame(buf, columns=_COLS)


def _open(path: str, content: bytes | None):
    zf = zipfile.ZipFile(io.BytesIO(content) if content is not None else local_path(path))
    return zf, _shared_strings(zf), _date_styles(zf), _date1904(zf)


def parse_workbook(path: str, content: bytes | None = None) -> Iterator[pd.DataFrame]:
    """All sheets of one workbook as ``CELL_SCHEMA`` frames of bounded size.

    With ``content`` the workbook is read from those bytes; without, it is
    opened at ``path`` on the worker's file system and its zip members are
    read lazily, so the file is never held in memory whole.
    """
    try:
        zf, shared, styles, d1904 = _open(path, content)
        sheets = _sheets(zf)
    except Exception as e:  # noqa: BLE001 - any unreadable file is reported, not raised
        yield pd.DataFrame([_problem(path, err=e)], columns=_COLS)
        return
    for sheet_no, (name, member) in enumerate(sheets):
        yield from _parse_sheet(zf, path, name, sheet_no, member, shared, styles, d1904)


SHEET_SCHEMA = "path string, sheet string, sheet_no int, member string, problem string"


def _list_sheets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, sheet, sheet_no, member) per sheet; reads only the workbook
    index, not the sheets. An unreadable file gives one row with a problem."""
    for pdf in batches:
        out = []
        for path in pdf["path"]:
            try:
                with zipfile.ZipFile(local_path(path)) as zf:
                    out += [[path, name, i, member, None] for i, (name, member) in enumerate(_sheets(zf))]
            except Exception as e:  # noqa: BLE001 - reported, not raised
                out.append([path, None, None, None, f"{type(e).__name__}: {e}"])
        yield pd.DataFrame(out, columns=["path", "sheet", "sheet_no", "member", "problem"])


def _parse_listed_sheets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, name, sheet_no, member, problem in pdf.itertuples(index=False):
            if problem is not None:
                yield pd.DataFrame([[path, None, None, -1, None, None, problem]], columns=_COLS)
                continue
            try:
                zf, shared, styles, d1904 = _open(path, None)
            except Exception as e:  # noqa: BLE001
                yield pd.DataFrame([_problem(path, name, sheet_no, err=e)], columns=_COLS)
                continue
            with zf:
                yield from _parse_sheet(zf, path, name, int(sheet_no), member, shared, styles, d1904)


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            yield from parse_workbook(path, content)


def _parse_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path in pdf["path"]:
            yield from parse_workbook(path)


def local_path(uri: str) -> str:
    """``file:/a/b`` or ``file:///a/b`` → ``/a/b``."""
    return "/" + uri[len("file:"):].lstrip("/") if uri.startswith("file:") else uri


def workers_can_open(files: DataFrame) -> bool:
    """True when every listed file has the ``file:`` scheme; what the listing
    resolved counts, not how the inbox was spelt."""
    return files.filter(~F.col("path").startswith("file:")).select("path").isEmpty()


def list_workbooks(spark: SparkSession, inbox: str | Sequence[str], pattern: str = "*.xlsx") -> DataFrame:
    """Files of the inbox (not recursive) whose names match ``pattern``;
    reading ``content`` is pruned away unless selected."""
    paths = [inbox] if isinstance(inbox, str) else list(inbox)
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths)


def scan_cells(files: DataFrame, by_path: bool = False, per_sheet: bool = True) -> DataFrame:
    """Parse every listed workbook on the executors (``CELL_SCHEMA`` rows).

    ``by_path`` ships only the paths (the listing never reads the bytes) and
    each worker opens its files itself: for inboxes on a local or mounted
    file system. Otherwise the bytes travel in the ``content`` column, which
    works for any file system Spark can read (object stores included).

    In path mode with ``per_sheet`` the work is split by sheet, not by file:
    a first pass lists each workbook's sheets (reading only its index), the
    (path, sheet) rows are spread round-robin over the cores, and each task
    parses single sheets, so a many-sheet workbook is not one task.
    """
    if by_path and per_sheet:
        cores = files.sparkSession.sparkContext.defaultParallelism
        listed = files.select("path").mapInPandas(_list_sheets, SHEET_SCHEMA).repartition(cores)
        return listed.mapInPandas(_parse_listed_sheets, CELL_SCHEMA)
    if by_path:
        return files.select("path").mapInPandas(_parse_paths, CELL_SCHEMA)
    return files.select("path", "content").mapInPandas(_parse_batches, CELL_SCHEMA)


def read_workbooks(
    spark: SparkSession, inbox: str | Sequence[str], pattern: str = "*.xlsx", by_path: bool | None = None
) -> DataFrame:
    """Parsed cells of every workbook in the inbox; ``by_path`` defaults to
    whether the inbox is on a file system the workers can open."""
    files = list_workbooks(spark, inbox, pattern)
    return scan_cells(files, workers_can_open(files) if by_path is None else by_path)


def to_rows(
    cells: DataFrame,
    positions: Sequence[int],
    names: Sequence[str],
    run_date=None,
    trim: bool = True,
    drop_blank: bool = True,
    blank_as_null: bool = False,
    lineage_col: str = "source_file",
    date_col: str = "load_date",
    arrival: bool = False,
) -> DataFrame:
    """Parsed cells → one all-text row per sheet row with the picked columns,
    lineage and (when ``run_date`` is given) the load-date stamp. Rows whose
    picked cells are all missing or blank are dropped. ``arrival`` adds the
    row's place in its file, ``sheet_no`` and ``row_no``. Rows of sheets that
    the width guard does not accept (:mod:`terrace.sources.sheets`) are left
    out; cells that know their sheet's decision (``accepted``) are not judged again."""
    if "accepted" not in cells.columns:
        cells = judged(cells, sheet_report(cells, positions))
    data = cells.filter((F.col("row_no") > 0) & F.col("accepted"))
    picked = cells_by_position("cells", positions, names)
    place = [F.col("sheet_no").cast("int").alias("sheet_no"), F.col("row_no").cast("long").alias("row_no")] if arrival else []
    out = data.select(*picked, lineage("path").alias(lineage_col), *place)
    if drop_blank:
        # the first cell with a text decides; of most rows one cell is looked at
        out = out.filter(reduce(lambda a, b: a | b, [strip_space(n) != "" for n in names]))
    kept = [c for c in out.columns if c not in names]
    if trim:
        out = out.select(*[strip_space(n).alias(n) for n in names], *kept)
    if blank_as_null:
        out = out.select(*[F.when(F.col(n) == "", None).otherwise(F.col(n)).alias(n) for n in names], *kept)
    if run_date is not None:
        out = out.withColumn(date_col, stamp_date(run_date))
    return out

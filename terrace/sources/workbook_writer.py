"""Write workbooks from a DataFrame, one file per group, on the executors.

Used to turn warehouse tables into inbox files (tests, fixtures, exports).
Input rows carry ``file``, ``sheet``, ``row_no`` and ``cells``, an array of
``struct<t string, v string>``: ``t`` is ``s`` (shared string), ``i``
(inline string), ``n`` (number) or ``d`` (ISO date written as a date-styled
day number); a NULL element leaves the cell out (a gap). Row numbers may
skip (blank rows). Each sheet gets a header row ``C0..C<w-1>`` as wide as
its widest data row.
"""

from __future__ import annotations

import datetime as _dt
import io
import os
import sys
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The functions Spark runs on executors live in this module; send them by
# value so workers need not have the package installed (no --py-files).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CT = """<?xml version="1.0" encoding="UTF-8" standalone="yes"?>
<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">
<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>
<Default Extension="xml" ContentType="application/xml"/>
<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>
<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>
<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>
{sheets}</Types>"""
_ROOT_RELS = """<?xml version="1.0" encoding="UTF-8" standalone="yes"?>
<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">
<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>
</Relationships>"""
_STYLES = """<?xml version="1.0" encoding="UTF-8" standalone="yes"?>
<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">
<numFmts count="1"><numFmt numFmtId="164" formatCode="dd/mm/yyyy"/></numFmts>
<fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>
<cellStyleXfs count="1"><xf/></cellStyleXfs>
<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="164" applyNumberFormat="1"/></cellXfs>
</styleSheet>"""
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_EPOCH = _dt.date(1899, 12, 30)


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


class _WorkbookStream:
    """One workbook written member by member: each sheet's XML streams into
    its zip member as rows arrive; shared strings, styles and the workbook
    index are written when the file is closed."""

    def __init__(self, path: str | None = None, buffer: io.BytesIO | None = None):
        self.path = path or ""
        self.tmp = path + ".tmp" if path else None
        self.zf = zipfile.ZipFile(self.tmp or buffer, "w", zipfile.ZIP_DEFLATED)
        self.shared: dict[str, int] = {}
        self.sheets: list[str] = []
        self.out = None
        self.rows = 0

    def start_sheet(self, name: str, width: int) -> None:
        self.end_sheet()
        self.sheets.append(name)
        self.out = self.zf.open(f"xl/worksheets/sheet{len(self.sheets)}.xml", "w")
        header = "".join(f'<c r="{_col_letters(j)}1" t="inlineStr"><is><t>C{j}</t></is></c>' for j in range(width))
        self.out.write(f'<worksheet xmlns="{_MAIN}"><sheetData><row r="1">{header}</row>'.encode())

    def add_row(self, row_no: int, cells) -> None:
        r = row_no + 2  # row 1 is the header
        xs = []
        for j, c in enumerate(cells if cells is not None else []):
            if c is None or c["v"] is None:
                continue
            t, v = c["t"], c["v"]
            ref = f"{_col_letters(j)}{r}"
            if t == "s":
                idx = self.shared.setdefault(v, len(self.shared))
                xs.append(f'<c r="{ref}" t="s"><v>{idx}</v></c>')
            elif t == "i":
                xs.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>')
            elif t == "d":
                serial = (_dt.date.fromisoformat(v) - _EPOCH).days
                xs.append(f'<c r="{ref}" s="{1 + (j % 2)}"><v>{serial}</v></c>')
            else:
                xs.append(f'<c r="{ref}"><v>{escape(v)}</v></c>')
        self.out.write(f'<row r="{r}">{"".join(xs)}</row>'.encode())
        self.rows += 1

    def end_sheet(self) -> None:
        if self.out is not None:
            self.out.write(b"</sheetData></worksheet>")
            self.out.close()
            self.out = None

    def close(self) -> None:
        self.end_sheet()
        k = len(self.sheets)
        sst = "".join(
            f'<si><t xml:space="preserve">{escape(s)}</t></si>'
            for s, _ in sorted(self.shared.items(), key=lambda kv: kv[1])
        )
        wb_sheets = "".join(
            f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(self.sheets, start=1)
        )
        rels = "".join(
            f'<Relationship Id="rId{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, k + 1)
        )
        rels += f'<Relationship Id="rId{k + 1}" Type="{_REL}/styles" Target="styles.xml"/>'
        rels += f'<Relationship Id="rId{k + 2}" Type="{_REL}/sharedStrings" Target="sharedStrings.xml"/>'
        ct_sheets = "".join(
            f'<Override PartName="/xl/worksheets/sheet{i}.xml" '
            'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>\n'
            for i in range(1, k + 1)
        )
        zf = self.zf
        zf.writestr("[Content_Types].xml", _CT.format(sheets=ct_sheets))
        zf.writestr("_rels/.rels", _ROOT_RELS)
        zf.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{wb_sheets}</sheets></workbook>')
        zf.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>',
        )
        zf.writestr("xl/styles.xml", _STYLES)
        n = len(self.shared)
        zf.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_MAIN}" count="{n}" uniqueCount="{n}">{sst}</sst>')
        zf.close()
        if self.tmp:
            os.replace(self.tmp, self.path)


def build_workbook(sheets: list[tuple[str, list[tuple[int, list]]]]) -> bytes:
    """A whole small workbook in memory (tests): ``sheets`` is
    ``[(name, [(row_no, cells)])]`` with cells ``None`` or ``(t, v)``."""
    buf = io.BytesIO()
    w = _WorkbookStream(buffer=buf)
    for name, rows in sheets:
        w.start_sheet(name, max((len(c) for _, c in rows), default=0))
        for row_no, cells in sorted(rows, key=lambda x: x[0]):
            w.add_row(row_no, [None if c is None else {"t": c[0], "v": c[1]} for c in cells])
    w.close()
    return buf.getvalue()


def write_workbooks(df: DataFrame, folder: str) -> DataFrame:
    """Write one workbook per distinct ``file`` into ``folder`` (a path every
    executor can reach). Returns ``(file, sheets, rows)`` per file, lazily:
    the files are written when the result is evaluated.

    Rows are hash-partitioned by file and sorted within partitions (Spark's
    external sort, which spills), then streamed into the zip: no task ever
    holds a whole file's rows in memory. A file is still written by one task.
    """
    local = folder.replace("file://", "").replace("file:", "")
    widths = df.groupBy("file", "sheet").agg(F.max(F.size("cells")).alias("_width"))
    rows = (
        df.join(widths, ["file", "sheet"])
        .repartition("file")
        .sortWithinPartitions("file", "sheet", "row_no")
        .select("file", "sheet", "row_no", "_width", "cells")
    )

    def write_partition(batches):
        os.makedirs(local, exist_ok=True)
        cur = None
        sheet = None
        done = []

        def finish():
            cur.close()
            done.append((os.path.basename(cur.path), len(cur.sheets), cur.rows))

        for pdf in batches:
            for f, sh, rn, w, cells in zip(pdf["file"], pdf["sheet"], pdf["row_no"], pdf["_width"], pdf["cells"]):
                if cur is None or os.path.basename(cur.path) != f:
                    if cur is not None:
                        finish()
                    cur, sheet = _WorkbookStream(os.path.join(local, f)), None
                if sh != sheet:
                    cur.start_sheet(sh, int(w))
                    sheet = sh
                cur.add_row(int(rn), cells)
        if cur is not None:
            finish()
        if done:
            yield pd.DataFrame(done, columns=["file", "sheets", "rows"])

    return rows.mapInPandas(write_partition, "file string, sheets int, rows long")


def cell(t: str, v) -> F.Column:
    """A typed cell for ``write_workbooks`` input."""
    return F.struct(F.lit(t).alias("t"), v.cast("string").alias("v"))

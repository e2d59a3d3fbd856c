"""Clean-up expressions: every function maps Column(s) to a Column.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen. Text → number / date conversions use the ``try_`` forms, so the
result never depends on ``spark.sql.ansi.enabled``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: these must equal the source pipeline's for equal results ---
# Date text formats, tried in this order; the first that parses wins.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy/MM/dd", "yyyyMMdd", "dd/MM/yy")
# Only the first 10 characters of a date cell are parsed.
DATE_PREFIX_LEN = 10
# Characters deleted from document numbers.
DOC_STRIP_CHARS = "'\"_"
# Document-type code → label, members feed (anything else, NULL included → OTROS).
MEMBER_DOC_LABELS = {1: "DNI", 2: "CE", 5: "PAS"}
MEMBER_DOC_OTHER = "OTROS"
# Document-type code → label, holders feed (anything else → OTRO).
HOLDER_DOC_LABELS = {1: "DNI", 6: "RUC"}
HOLDER_DOC_OTHER = "OTRO"
# Document numbers of these lengths, all digits, are left-padded with zeros to 8.
PAD_LENGTHS = (5, 6, 7)
PAD_WIDTH = 8
PAD_CHAR = "0"
# Scale of the decimal a whole number passes through (rounds half up there).
WHOLE_NUMBER_SCALE = 2
# Precision of that decimal for short codes (year, month, type) ...
CODE_PRECISION = 10
# ... and for identifiers, wide enough that 18-digit ids survive (quirk Q2).
ID_PRECISION = 20
# --- end of fixed values ---

# Leading/trailing white space as Python's str.strip() sees it: every Unicode
# white-space character plus the four ASCII separators U+001C..U+001F.
_EDGE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_chars(c: str | Column, chars: str = DOC_STRIP_CHARS) -> Column:
    """Delete every occurrence of the given characters."""
    return F.translate(_c(c), chars, "")


def last_digit(c: str | Column) -> Column:
    """Last character as int; a letter or an empty string gives NULL."""
    return F.substring(_c(c), -1, 1).try_cast("int")


def whole_number_via_decimal(
    c: str | Column, precision: int = CODE_PRECISION, to: str = "bigint"
) -> Column:
    """Text → decimal(p, 2) (rounds half up, accepts exponents and blanks
    around the number) → whole number (truncates). Out of range → NULL."""
    return _c(c).try_cast(f"decimal({precision},{WHOLE_NUMBER_SCALE})").try_cast(to)


def whole_number_via_integer(c: str | Column, to: str = "int") -> Column:
    """Text → whole number by truncating a plain decimal literal.

    ``'2024.0'`` → 2024, ``'3.999'`` → 3, ``'12.'`` → 12; exponents, a bare
    fraction (``'.5'``) and out-of-range values give NULL.
    """
    digits = F.regexp_extract(F.trim(_c(c)), r"^([+-]?[0-9]+)([.][0-9]*)?$", 1)
    return digits.try_cast(to)


def join_name(*parts: str | Column, full_collapse: bool = False) -> Column:
    """Blank-joined name parts (NULLs skipped, empty parts still separated),
    trimmed, then double blanks collapsed once (or fully)."""
    joined = F.trim(F.concat_ws(" ", *[_c(p) for p in parts]))
    return F.regexp_replace(joined, " +" if full_collapse else "  ", " ")


def label_code(code: str | Column, labels: Mapping[int, str], other: str) -> Column:
    """Integer code → label through a fixed map; unmatched and NULL → ``other``."""
    code = _c(code)
    expr = None
    for key, label in labels.items():
        expr = F.when(code == key, label) if expr is None else expr.when(code == key, label)
    return expr.otherwise(other) if expr is not None else F.lit(other)


def pad_digits(
    c: str | Column,
    lengths: Iterable[int] = PAD_LENGTHS,
    width: int = PAD_WIDTH,
    when: Column | None = None,
) -> Column:
    """Left-pad an all-digit value whose length is in ``lengths`` to ``width``;
    anything else (and anything failing ``when``) passes unchanged."""
    c = _c(c)
    cond = F.length(c).isin(list(lengths)) & c.rlike(r"^\d+$")
    if when is not None:
        cond = cond & when
    return F.when(cond, F.lpad(c, width, PAD_CHAR)).otherwise(c)


def _shape(fmt: str) -> str | None:
    """A regex every text the pattern can parse must match, or None.

    A failed parse costs a thrown and caught exception per row, so each
    pattern is only tried on text of its exact shape. The parser reads ASCII
    digits only; ``dd``/``MM``/``yy`` are fixed at two digits and a year
    without a sign needs four or more, so these shapes exclude only text that
    cannot parse (``tests/test_columns.py`` checks it against the unguarded
    form). ``yyyyMMdd`` keeps room for a wider year.
    """
    shapes = {
        "yyyy-MM-dd": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
        "dd/MM/yyyy": r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$",
        "dd-MM-yyyy": r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$",
        "yyyy/MM/dd": r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$",
        "yyyyMMdd": r"^[0-9]{8,10}$",
        "dd/MM/yy": r"^[0-9]{2}/[0-9]{2}/[0-9]{2}$",
    }
    return shapes.get(fmt)


def parse_date(c: str | Column, formats: Iterable[str] = DATE_FORMATS, guard: bool = True) -> Column:
    """First ``DATE_PREFIX_LEN`` characters parsed by the first matching format."""
    head = F.substring(_c(c), 1, DATE_PREFIX_LEN)
    tries = []
    for fmt in formats:
        attempt = F.try_to_date(head, fmt)
        shape = _shape(fmt) if guard else None
        tries.append(F.when(head.rlike(shape), attempt) if shape else attempt)
    return F.coalesce(*tries)


def strip_space(c: str | Column) -> Column:
    """Remove leading and trailing white space of every kind (tabs, newlines,
    no-break and ideographic spaces), not only blanks. Only the edges are looked at."""
    return F.btrim(_c(c), F.lit(_EDGE_SPACE))


def stamp_date(run_date) -> Column:
    """The load-date stamp: an explicit run date, never the wall clock."""
    return F.lit(str(run_date)).cast("date")


def local_date(instant: str | Column, zone: str) -> Column:
    """The calendar date of a UTC instant in ``zone`` (one shift, from UTC)."""
    c = F.col(instant) if isinstance(instant, str) else instant
    return F.to_date(F.from_utc_timestamp(c, zone))


def run_date_of(text: str | Column) -> Column:
    """``yyyy-MM-dd`` → date; NULL for any other text (the column form of the run-date argument)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(c, "yyyy-MM-dd"))

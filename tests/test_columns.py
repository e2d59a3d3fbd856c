"""Expression cases (input → expected), each under ANSI on and off."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.functions import columns as C


def one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


D = dt.date(2024, 1, 15)


def test_parse_date_formats(spark, ansi):
    good = ["2024-01-15", "2024-01-15 00:00:00", "15/01/2024", "15/01/2024 10:00", "15-01-2024",
            "2024/01/15", "20240115", "15/01/24"]
    assert one(spark, C.parse_date, good) == [D] * len(good)


def test_parse_date_rejects(spark, ansi):
    bad = ["1/2/2024", "15/1/24", "2024-1-5", "31/02/2024", "45306", "", "   ", None]
    assert one(spark, C.parse_date, bad) == [None] * len(bad)


def test_two_digit_year_is_2000s(spark):
    assert one(spark, C.parse_date, ["02/01/95"]) == [dt.date(2095, 1, 2)]


# Text made of digits and date separators, of the lengths that matter.
date_like = st.text(alphabet="0123456789/- :+", min_size=0, max_size=12)


@settings(max_examples=60, deadline=None)
@given(st.lists(date_like, min_size=1, max_size=200))
def test_shape_guard_never_changes_result(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = df.select(C.parse_date("x").alias("a"), C.parse_date("x", guard=False).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_whole_number_via_decimal(spark, ansi):
    vals = ["12345678", "12345678.0", "123456789", "99999999.995", "3.999", "-3.999", "1e3", " 7 ", "abc"]
    assert one(spark, lambda c: C.whole_number_via_decimal(c, 10, "bigint"), vals) == [
        12345678, 12345678, None, None, 4, -4, 1000, 7, None]


def test_whole_number_via_decimal_wide_ids(spark, ansi):
    assert one(spark, lambda c: C.whole_number_via_decimal(c, C.ID_PRECISION), ["123456789012.0"]) == [123456789012]


def test_whole_number_via_integer(spark, ansi):
    vals = ["2024.0", "3.999", "-3.999", "12.", ".5", "1e3", "abc", "", "99999999999"]
    assert one(spark, C.whole_number_via_integer, vals) == [2024, 3, -3, 12, None, None, None, None, None]


def test_strip_chars_and_last_digit(spark, ansi):
    assert one(spark, C.strip_chars, ["'12\"3_4"]) == ["1234"]
    assert one(spark, C.last_digit, ["12345678", "12X", ""]) == [8, None, None]


def test_pad_digits(spark):
    vals = ["12345", "1234567", "1234", "12345678", "12a45", "123456"]
    assert one(spark, C.pad_digits, vals) == ["00012345", "01234567", "1234", "12345678", "12a45", "00123456"]


def test_pad_digits_only_when(spark):
    df = spark.createDataFrame([("12345", "DNI"), ("12345", "RUC")], "d string, t string")
    got = df.select(C.pad_digits("d", when=F.col("t") == "DNI")).collect()
    assert [r[0] for r in got] == ["00012345", "12345"]


def test_join_name(spark):
    df = spark.createDataFrame([(None, "A", "", "B"), ("A", "  ", "B", None)], "a string, b string, c string, d string")
    got = [r[0] for r in df.select(C.join_name("a", "b", "c", "d")).collect()]
    assert got == ["A B", "A  B"]  # single pass: 4 blanks → 2
    full = [r[0] for r in df.select(C.join_name("a", "b", "c", "d", full_collapse=True)).collect()]
    assert full == ["A B", "A B"]


def test_collapse_single_pass(spark):
    assert one(spark, lambda c: F.regexp_replace(c, "  ", " "), ["a   b", "a    b"]) == ["a  b", "a  b"]


def test_labels(spark):
    codes = [1, 2, 5, 6, 9, None]
    m = one(spark, lambda c: C.label_code(c, C.MEMBER_DOC_LABELS, C.MEMBER_DOC_OTHER), codes, "int")
    h = one(spark, lambda c: C.label_code(c, C.HOLDER_DOC_LABELS, C.HOLDER_DOC_OTHER), codes, "int")
    assert m == ["DNI", "CE", "PAS", "OTROS", "OTROS", "OTROS"]
    assert h == ["DNI", "OTRO", "OTRO", "RUC", "OTRO", "OTRO"]


def test_strip_space_unicode(spark):
    assert one(spark, C.strip_space, ["  a b\t\n", "　x ", None, "\x1cy\x1f"]) == ["a b", "x", None, "y"]


def test_stamp_is_the_run_date(spark):
    assert spark.range(1).select(C.stamp_date("2026-01-15")).first()[0] == dt.date(2026, 1, 15)


@pytest.mark.parametrize("fmt", C.DATE_FORMATS)
def test_each_format_alone(spark, fmt):
    text = {"yyyy-MM-dd": "2024-01-15", "dd/MM/yyyy": "15/01/2024", "dd-MM-yyyy": "15-01-2024",
            "yyyy/MM/dd": "2024/01/15", "yyyyMMdd": "20240115", "dd/MM/yy": "15/01/24"}[fmt]
    assert one(spark, lambda c: C.parse_date(c, [fmt]), [text]) == [D]


def _model_whole_int(t):
    """The rule written plainly: a plain decimal literal, truncated, in int range."""
    import re as _re

    if t is None:
        return None
    m = _re.fullmatch(r"([+-]?[0-9]+)([.][0-9]*)?", t.strip(" "))
    if not m:
        return None
    v = int(m.group(1))
    return v if -(2**31) <= v < 2**31 else None


def _model_pad(t):
    if t is None:
        return None
    if len(t) in (5, 6, 7) and t.isascii() and t.isdigit():
        return t.rjust(8, "0")
    return t


number_like = st.one_of(st.none(), st.text(alphabet="0123456789.+-e ", max_size=14))
doc_like = st.one_of(st.none(), st.text(alphabet="0123456789X'_", max_size=9))


@settings(max_examples=40, deadline=None)
@given(st.lists(number_like, min_size=1, max_size=200))
def test_whole_number_via_integer_matches_model(spark, texts):
    got = one(spark, C.whole_number_via_integer, texts)
    assert got == [_model_whole_int(t) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(doc_like, min_size=1, max_size=200))
def test_pad_digits_matches_model(spark, texts):
    assert one(spark, C.pad_digits, texts) == [_model_pad(t) for t in texts]

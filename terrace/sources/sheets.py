"""The width guard: a decision about a whole sheet, the same for every source of cells.

A sheet is loaded when its width — its header line's, or its widest row's where
it has no header line — reaches past the highest position, and nothing in it was
unreadable. A row that ends early keeps its place: cells behind its end are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHEET = ("path", "sheet", "sheet_no")
NARROW, UNREADABLE = "narrow", "unreadable"


def accepted(width: Column | str, positions: Sequence[int]) -> Column:
    """A sheet is wide enough when it reaches past the highest position."""
    w = F.col(width) if isinstance(width, str) else width
    return w > F.lit(max(positions))


def sheet_report(cells: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Per sheet: its width, data rows, accepted or not, and any problem."""
    header = F.max(F.when(F.col("row_no") == 0, F.col("width")))
    return (
        cells.groupBy(*SHEET)
        .agg(
            F.coalesce(header, F.max("width")).alias("width"),
            F.count_if((F.col("row_no") > 0) & (F.size("cells") > 0)).alias("data_rows"),
            F.max("problem").alias("problem"),
        )
        .select(
            *SHEET,
            "width",
            "data_rows",
            (F.coalesce(accepted("width", positions), F.lit(False)) & F.col("problem").isNull()).alias("accepted"),
            "problem",
        )
    )


def reason() -> Column:
    """Why a line of :func:`sheet_report` is not accepted; NULL if it is."""
    return (
        F.when(F.col("accepted"), F.lit(None).cast("string"))
        .when(F.col("problem").isNotNull(), F.lit(UNREADABLE))
        .otherwise(F.lit(NARROW))
    )


def judged(cells: DataFrame, report: DataFrame) -> DataFrame:
    """``cells`` with their sheet's ``accepted`` and ``reason``.

    The report has a line for each sheet, so whether it is broadcast is left to
    its size; the rows themselves are not shuffled where it is small.
    """
    line = report.select(*[F.col(c).alias(f"_{c}") for c in SHEET], "accepted", reason().alias("reason"), F.col("problem").alias("_problem"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SHEET]
    return cells.join(line, same, "left").drop(*[f"_{c}" for c in SHEET])


def rejected_rows(cells: DataFrame, report: DataFrame) -> DataFrame:
    """Rows of the sheets that were not loaded, as they came, with the reason; unreadable places keep their problem."""
    bad = judged(cells, report.filter(~F.col("accepted"))).filter(F.col("reason").isNotNull() & (F.col("row_no") != 0))
    return bad.select(*SHEET, F.col("row_no").cast("long").alias("row_no"), "reason", F.coalesce("problem", "_problem").alias("problem"), "cells")

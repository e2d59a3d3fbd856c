"""The two feeds' clean-up (raw → clean) and the consolidation (clean →
reporting). Pure DataFrame functions; storing is in :mod:`terrace.plans.runs`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.operators import frames


@dataclass(frozen=True)
class Feed:
    name: str
    positions: tuple[int, ...]  # 0-based workbook column positions
    raw_columns: tuple[str, ...]  # names given to those positions
    keys: tuple[str, ...]  # business key of the clean table
    clean_columns: tuple[str, ...]  # clean table, in order
    min_width: int  # a sheet narrower than this is rejected


# --- fixed values: workbook layouts and keys of the two feeds ---
MEMBERS = Feed(
    name="members",
    positions=(1, 2, 3, 5, 6, 7, 8, 9, 10, 11, 12, 13, 18, 19),
    raw_columns=(
        "policy_id", "policy_start", "policy_end", "certificate", "cover_start", "cover_end",
        "first_name", "second_name", "surname_1", "surname_2", "doc_type", "doc_no",
        "mov_year", "mov_month",
    ),
    keys=("policy_id", "certificate", "doc_no", "mov_year", "mov_month"),
    clean_columns=(
        "policy_id", "policy_start", "policy_end", "certificate", "cover_start", "cover_end",
        "doc_type", "doc_no", "doc_last_digit", "member_name", "mov_year", "mov_month", "load_date",
    ),
    min_width=20,
)
HOLDERS = Feed(
    name="holders",
    positions=(1, 2, 3, 6, 8, 9),
    raw_columns=("doc_type", "holder_doc_no", "holder_name", "policy_id", "mov_year", "mov_month"),
    keys=("policy_id", "holder_doc_no", "mov_year", "mov_month"),
    clean_columns=("policy_id", "doc_type", "holder_doc_no", "holder_name", "mov_year", "mov_month", "load_date"),
    min_width=10,
)
MEMBER_DATE_COLUMNS = ("policy_start", "policy_end", "cover_start", "cover_end")
# Gold: members' columns, then the holder's document and name.
GOLD_COLUMNS = (
    "policy_id", "policy_start", "policy_end", "cover_start", "cover_end",
    "holder_doc_no", "holder_name", "doc_type", "doc_no", "doc_last_digit", "member_name",
)
# Reporting-table clustering columns.
GOLD_CLUSTER_BY = ("doc_last_digit", "doc_no")
# --- end of fixed values ---
#: Prefix of the raw texts that stand beside the parsed columns while they are counted.
RAW = "_raw_"
MEMBER_PARSED = ("policy_id", *MEMBER_DATE_COLUMNS, "mov_year", "mov_month")


def clean_members(
    raw: DataFrame,
    run_date,
    id_precision: int = C.ID_PRECISION,
    full_collapse: bool = False,
    distinct: bool = True,
    carry: tuple[str, ...] = (),
    watch: Observation | None = None,
) -> DataFrame:
    """Raw members → typed, normalised, de-duplicated members. ``carry`` keeps
    raw columns (the order of arrival) behind the clean ones; ``watch`` observes
    the counts of :func:`member_reject_counts` on the parsed columns, so that
    nothing is parsed a second time for them.

    One projection (Catalyst collapses it with the scan's), one filter on the
    parsed policy id, then a full-row ``distinct`` (skipped with
    ``distinct=False`` when a latest-per-key step follows, which removes
    exact duplicates anyway).
    """
    doc = C.strip_chars("doc_no")
    typed = raw.select(
        C.whole_number_via_decimal("policy_id", id_precision, "bigint").alias("policy_id"),
        *[C.parse_date(c).alias(c) for c in MEMBER_DATE_COLUMNS],
        F.col("certificate"),
        C.label_code(
            C.whole_number_via_decimal("doc_type", C.CODE_PRECISION, "int"),
            C.MEMBER_DOC_LABELS,
            C.MEMBER_DOC_OTHER,
        ).alias("doc_type"),
        C.pad_digits(doc).alias("doc_no"),
        C.last_digit(doc).alias("doc_last_digit"),
        C.join_name("first_name", "second_name", "surname_1", "surname_2", full_collapse=full_collapse).alias(
            "member_name"
        ),
        C.whole_number_via_decimal("mov_year", C.CODE_PRECISION, "int").alias("mov_year"),
        C.whole_number_via_decimal("mov_month", C.CODE_PRECISION, "int").alias("mov_month"),
        C.stamp_date(run_date).alias("load_date"),
        *carry,
        *([F.col(c).alias(RAW + c) for c in MEMBER_PARSED] if watch else []),
    )
    if watch:
        counts = [_unparsed(RAW + c, F.col(c), c) for c in MEMBER_PARSED]
        typed = typed.observe(watch, F.count(F.lit(1)).alias("rows"), *counts)
    out = frames.require(typed, "policy_id").select(*MEMBERS.clean_columns, *carry)
    return out.distinct() if distinct else out


def _unparsed(text: str, parsed: Column, name: str | None = None) -> Column:
    return F.count_if(F.col(text).isNotNull() & parsed.isNull()).alias(f"{name or text}_unparsed")


def member_reject_counts(id_precision: int = C.ID_PRECISION) -> list[Column]:
    """Aggregates over a raw members batch: rows, and per column the rows
    whose text is present but does not parse (these become NULL; a NULL
    policy id drops the row)."""
    unparsed = _unparsed
    return [
        F.count(F.lit(1)).alias("rows"),
        unparsed("policy_id", C.whole_number_via_decimal("policy_id", id_precision, "bigint")),
        *[unparsed(c, C.parse_date(c)) for c in MEMBER_DATE_COLUMNS],
        unparsed("mov_year", C.whole_number_via_decimal("mov_year", C.CODE_PRECISION, "int")),
        unparsed("mov_month", C.whole_number_via_decimal("mov_month", C.CODE_PRECISION, "int")),
    ]


def holder_reject_counts(id_precision: int = C.ID_PRECISION) -> list[Column]:
    """Aggregates over a raw holders batch: rows, text present but
    unparseable per column, and rows without a holder name (dropped)."""
    unparsed = _unparsed
    return [
        F.count(F.lit(1)).alias("rows"),
        unparsed("policy_id", C.whole_number_via_decimal("policy_id", id_precision, "bigint")),
        unparsed("doc_type", C.whole_number_via_integer("doc_type")),
        unparsed("mov_year", C.whole_number_via_integer("mov_year")),
        unparsed("mov_month", C.whole_number_via_integer("mov_month")),
        F.count_if(F.col("holder_name").isNull()).alias("holder_name_missing"),
    ]


def member_rejects(raw: DataFrame, id_precision: int = C.ID_PRECISION) -> DataFrame:
    """One row of :func:`member_reject_counts`, combined map-side."""
    return raw.agg(*member_reject_counts(id_precision))


def holder_rejects(raw: DataFrame, id_precision: int = C.ID_PRECISION) -> DataFrame:
    """One row of :func:`holder_reject_counts`, combined map-side."""
    return raw.agg(*holder_reject_counts(id_precision))


def clean_holders(
    raw: DataFrame,
    run_date,
    id_precision: int = C.ID_PRECISION,
    distinct: bool = True,
    carry: tuple[str, ...] = (),
    watch: Observation | None = None,
) -> DataFrame:
    """Raw holders → typed, normalised, de-duplicated holders (``carry`` and ``watch`` as for members)."""
    doc = C.strip_chars("holder_doc_no")
    label = C.label_code(C.whole_number_via_integer("doc_type"), C.HOLDER_DOC_LABELS, C.HOLDER_DOC_OTHER)
    typed = raw.select(
        C.whole_number_via_decimal("policy_id", id_precision, "bigint").alias("policy_id"),
        label.alias("doc_type"),
        C.pad_digits(doc, when=label == F.lit("DNI")).alias("holder_doc_no"),
        F.col("holder_name"),
        C.whole_number_via_integer("mov_year").alias("mov_year"),
        C.whole_number_via_integer("mov_month").alias("mov_month"),
        C.stamp_date(run_date).alias("load_date"),
        *carry,
        *([F.col(c).alias(RAW + c) for c in ("policy_id", "mov_year", "mov_month", "doc_type")] if watch else []),
    )
    if watch:
        typed = typed.observe(
            watch,
            F.count(F.lit(1)).alias("rows"),
            *[_unparsed(RAW + c, F.col(c), c) for c in ("policy_id", "mov_year", "mov_month")],
            _unparsed(RAW + "doc_type", C.whole_number_via_integer(RAW + "doc_type"), "doc_type"),  # the clean one is its label
            F.count_if(F.col("holder_name").isNull()).alias("holder_name_missing"),
        )
    out = frames.require(typed, "policy_id", "holder_name").select(*HOLDERS.clean_columns, *carry)
    return out.distinct() if distinct else out


def hot_policies(members: DataFrame, support: float = 0.005) -> list:
    """Policies that may hold more than ``support`` of the members: a frequent-items
    sketch, merged from the partitions, that misses none and keeps at most
    ``1 / support`` (some may be rarer; that costs a few repeated holders, no row)."""
    found = members.select("policy_id").stat.freqItems(["policy_id"], support).first()[0]
    return sorted(p for p in found if p is not None)


def salted_sides(m: DataFrame, h: DataFrame, salt: int, hot: list | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: a member row gets one value by its hash, a holder row is
    repeated for each; with ``hot`` only rows of those policies, all others have salt 0."""
    split = F.pmod(F.xxhash64(*m.columns), F.lit(salt)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salt - 1))
    if hot is not None:
        is_hot = F.col("policy_id").isin(hot) if hot else F.lit(False)
        split = F.when(is_hot, split).otherwise(F.lit(0))
        every = F.when(is_hot, every).otherwise(F.array(F.lit(0)))
    return m.withColumn("_salt", split), h.withColumn("_salt", F.explode(every))


def consolidate(
    members: DataFrame, holders: DataFrame, by_period: bool = False, salt: int = 0, hot: list | None = None
) -> DataFrame:
    """Members left-joined to holders on policy (and period when asked),
    projected to the reporting columns, de-duplicated.

    Both sides are de-duplicated on exactly the columns the result uses
    *before* the join. Then every output row comes from a distinct
    (member, holder) pair and differs from every other output row, so the
    result is already distinct and the join output — the largest frame in
    the plan, many-to-many per policy — is never shuffled again.

    A policy holding a large share of the members is split by AQE's skew
    join. Where AQE is off, ``salt > 1`` splits every policy explicitly:
    each member row gets one salt from a hash of its columns and the
    de-duplicated holders side is repeated once per salt value, so a
    member still meets each of its policy's holders exactly once. With ``hot``
    (:func:`hot_policies`) only those policies are split and only their holders
    repeated; which ones they are never changes the result.
    """
    period = ["mov_year", "mov_month"] if by_period else []
    m_cols = [c for c in GOLD_COLUMNS if c not in ("holder_doc_no", "holder_name")] + period
    h_keys = ["policy_id"] + period
    h = holders.select(*h_keys, "holder_doc_no", "holder_name").distinct()
    m = members.select(*m_cols).distinct()
    if salt > 1:
        m, h = salted_sides(m, h, salt, hot)
        h_keys = h_keys + ["_salt"]
    joined = m.join(h, on=h_keys, how="left").select(*GOLD_COLUMNS)
    # With the period in the join, members differing only in period project
    # onto the same output row, so the pair argument no longer holds: one more
    # distinct after the join. The one before it keeps exact repeats of a
    # member from fanning out over its holders.
    return joined.distinct() if by_period else joined


def report_from_raw(
    members_raw: DataFrame, holders_raw: DataFrame, run_date, by_period: bool = False, salt: int = 0
) -> DataFrame:
    """Clean both raw feeds and consolidate them in one plan.

    :func:`consolidate` de-duplicates each side on the columns it uses (or
    the result once, by period), and a distinct over a projection of a
    distinct equals the distinct over the projection; so the clean-ups'
    own full-row ``distinct`` — one shuffle per feed — is left out.
    """
    return consolidate(
        clean_members(members_raw, run_date, distinct=False),
        clean_holders(holders_raw, run_date, distinct=False),
        by_period,
        salt,
    )

"""Registered queries: ``key -> (spark, sf_dir) -> DataFrame``.

Every query reads the given parquet tables (or frames Spark derives from
them) in full; none runs on made-up input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.operators import frames, layout, maintenance, statistics, upsert
from terrace.plans import bronze, feeds, medallion, report, runs
from terrace.plans.manifest import Manifest
from terrace.session import scratch_dir
from terrace.sources import drops, tables
from terrace.sources import workbooks as wb
from terrace.sources.tables import read_parquet
from terrace.sources.workbook_writer import cell, write_workbooks
from terrace.streaming import incremental

RUN_DATE = "2026-01-15"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str, spread_out: bool = False) -> DataFrame:
    """A warehouse table. ``spread_out`` only for inputs of CPU-heavy row-wise
    work (the feed derivation and clean-up, sort-based partial aggregation);
    hash aggregates and joins start with a shuffle anyway and are faster
    without an extra one (measured)."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", spread_out)


def members_raw(spark, sf_dir) -> DataFrame:
    return feeds.members_raw(table(spark, sf_dir, "lineitem", spread_out=True))


def holders_raw(spark, sf_dir) -> DataFrame:
    return feeds.holders_raw(table(spark, sf_dir, "orders", spread_out=True), table(spark, sf_dir, "customer"))


@register("silver_members")
def silver_members(spark, sf_dir):
    return medallion.clean_members(members_raw(spark, sf_dir), RUN_DATE)


@register("silver_holders")
def silver_holders(spark, sf_dir):
    return medallion.clean_holders(holders_raw(spark, sf_dir), RUN_DATE)


@register("gold_consolidated")
def gold_consolidated(spark, sf_dir):
    return medallion.report_from_raw(members_raw(spark, sf_dir), holders_raw(spark, sf_dir), RUN_DATE)


@register("gold_salted")
def gold_salted(spark, sf_dir):
    """The reporting join with every policy split into 8 salted parts (the
    skew remedy that does not depend on AQE); same result as gold_consolidated."""
    return medallion.report_from_raw(members_raw(spark, sf_dir), holders_raw(spark, sf_dir), RUN_DATE, salt=8)


@register("gold_heavy_hitters")
def gold_heavy_hitters(spark, sf_dir):
    """The reporting join with only the policies of many members split, as a
    frequent-items sketch finds them; same result as gold_consolidated."""
    members = medallion.clean_members(members_raw(spark, sf_dir), RUN_DATE, distinct=False)
    holders = medallion.clean_holders(holders_raw(spark, sf_dir), RUN_DATE, distinct=False)
    return medallion.consolidate(members, holders, salt=8, hot=medallion.hot_policies(members, support=0.02))


@register("gold_by_period")
def gold_by_period(spark, sf_dir):
    return medallion.report_from_raw(members_raw(spark, sf_dir), holders_raw(spark, sf_dir), RUN_DATE, by_period=True)


# --- column clean-up rules, one query each -------------------------------


SLICE_DATE = "1998-06-01"


@register("clean_doc_numbers")
def clean_doc_numbers(spark, sf_dir):
    raw = members_raw(spark, sf_dir)
    doc = C.strip_chars("doc_no")
    return raw.select(
        F.col("doc_no"),
        doc.alias("doc_clean"),
        C.last_digit(doc).alias("doc_last_digit"),
        F.trim(F.concat(F.col("surname_1"), F.col("surname_2"), F.col("surname_1"))).alias("surname_trimmed"),
    )


@register("pad_doc_any")
def pad_doc_any(spark, sf_dir):
    raw = members_raw(spark, sf_dir)
    doc = C.strip_chars("doc_no")
    return raw.select(F.col("doc_no"), C.pad_digits(doc).alias("doc_padded"))


@register("pad_doc_typed")
def pad_doc_typed(spark, sf_dir):
    raw = holders_raw(spark, sf_dir)
    doc = C.strip_chars("holder_doc_no")
    label = C.label_code(C.whole_number_via_integer("doc_type"), C.HOLDER_DOC_LABELS, C.HOLDER_DOC_OTHER)
    return raw.select(
        F.col("holder_doc_no"),
        label.alias("doc_label"),
        C.pad_digits(doc, when=label == F.lit("DNI")).alias("doc_padded"),
    )


@register("whole_number_decimal")
def whole_number_decimal(spark, sf_dir):
    raw = members_raw(spark, sf_dir)
    return raw.select(
        F.col("policy_id"),
        C.whole_number_via_decimal("policy_id", C.ID_PRECISION, "bigint").alias("policy_wide"),
        C.whole_number_via_decimal("policy_id", C.CODE_PRECISION, "bigint").alias("policy_narrow"),
        F.col("mov_month"),
        C.whole_number_via_decimal("mov_month", C.CODE_PRECISION, "int").alias("month_int"),
    )


@register("whole_number_int")
def whole_number_int(spark, sf_dir):
    raw = holders_raw(spark, sf_dir)
    return raw.select(
        F.col("doc_type"),
        C.whole_number_via_integer("doc_type").alias("doc_type_int"),
        F.col("mov_month"),
        C.whole_number_via_integer("mov_month").alias("month_int"),
        C.whole_number_via_integer("mov_year").alias("year_int"),
    )


@register("parse_dates")
def parse_dates(spark, sf_dir):
    raw = members_raw(spark, sf_dir)
    cols = medallion.MEMBER_DATE_COLUMNS
    return raw.select(*[F.col(c).alias(f"{c}_text") for c in cols], *[C.parse_date(c).alias(c) for c in cols])


@register("full_name")
def full_name(spark, sf_dir):
    raw = members_raw(spark, sf_dir)
    parts = ("first_name", "second_name", "surname_1", "surname_2")
    return raw.select(
        *parts,
        C.join_name(*parts).alias("member_name"),
        C.join_name(*parts, full_collapse=True).alias("member_name_collapsed"),
    )


@register("label_codes")
def label_codes(spark, sf_dir):
    raw = holders_raw(spark, sf_dir)
    return raw.select(
        F.col("doc_type"),
        C.label_code(
            C.whole_number_via_decimal("doc_type", C.CODE_PRECISION, "int"), C.MEMBER_DOC_LABELS, C.MEMBER_DOC_OTHER
        ).alias("member_label"),
        C.label_code(C.whole_number_via_integer("doc_type"), C.HOLDER_DOC_LABELS, C.HOLDER_DOC_OTHER).alias(
            "holder_label"
        ),
    )


@register("load_slice")
def load_slice(spark, sf_dir):
    raw = members_raw(spark, sf_dir)
    batch = frames.load_slice(raw, SLICE_DATE)
    return batch.select(*medallion.MEMBERS.raw_columns, "source_file", "load_date", C.stamp_date(RUN_DATE).alias("run_date"))


@register("required_keys")
def required_keys(spark, sf_dir):
    raw = holders_raw(spark, sf_dir)
    typed = raw.select(
        C.whole_number_via_decimal("policy_id", C.ID_PRECISION, "bigint").alias("policy_id"),
        F.col("holder_name"),
        F.col("holder_doc_no"),
    )
    return frames.require(typed, "policy_id", "holder_name")


@register("drop_blank_rows")
def drop_blank_rows(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    blanked = ev.select(
        eid,
        F.when(eid % 4 == 0, F.lit(None)).otherwise(F.col("user_id").cast("string")).alias("user_text"),
        F.when(eid % 4 <= 1, F.lit(None)).otherwise(F.col("event_type")).alias("type_text"),
        F.when(eid % 2 == 0, F.lit(None)).otherwise(F.col("props")).alias("props_text"),
    )
    return frames.drop_blank_rows(blanked, ["user_text", "type_text", "props_text"])


@register("pick_by_position")
def pick_by_position(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    cells = F.array(*[F.col(c).cast("string") for c in cust.columns])
    # Position 7 is past the row's end and yields NULL, like a short sheet row.
    picked = frames.cells_by_position(cells, (4, 0, 2, 1, 7), ("segment", "holder_id", "nation", "holder_name", "extra"))
    return cust.select(*picked)


@register("pick_columns")
def pick_columns(spark, sf_dir):
    """The frame form: columns by position, renamed, all as text."""
    picked = frames.pick_by_position(
        table(spark, sf_dir, "customer"), (4, 0, 2, 1), ("segment", "holder_id", "nation", "holder_name")
    )
    return frames.as_text(picked)


# Edge padding put around part names: blanks, tab/newline, ideographic and
# no-break spaces, or none.
PADS = (("  ", " "), ("\t", "\n"), ("　", " "), ("", ""))


@register("trim_all")
def trim_all(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    padded = None
    for i, (lead, trail) in enumerate(PADS):
        val = F.concat(F.lit(lead), F.col("p_name"), F.lit(trail))
        padded = F.when(k == i, val) if padded is None else padded.when(k == i, val)
    df = part.select("p_partkey", padded.alias("name_text"), padded.alias("name"))
    return frames.trim_all(df, ["name"])


@register("stack_feeds")
def stack_feeds(spark, sf_dir):
    base = sf_dir.rstrip("/")
    sup = spark.read.parquet(f"{base}/supplier.parquet")
    cus = spark.read.parquet(f"{base}/customer.parquet")

    def shape(df, key, name, nation):
        return df.select(
            F.col(key).cast("string").alias("party_id"),
            F.col(name).alias("party_name"),
            F.col(nation).cast("string").alias("nation"),
            frames.file_name(F.col("_metadata.file_path")).alias("source_file"),
        )

    return frames.stack([shape(sup, "s_suppkey", "s_name", "s_nationkey"), shape(cus, "c_custkey", "c_name", "c_nationkey")])


LINE_KEYS = ("l_orderkey", "l_linenumber")


@register("dedup_rows")
def dedup_rows(spark, sf_dir):
    return frames.dedup_rows(table(spark, sf_dir, "lineitem"))


@register("dedup_latest")
def dedup_latest(spark, sf_dir):
    # The per-key aggregate is sort-based (struct values), heavy enough per
    # row to be worth spreading a single-split scan first (measured).
    return frames.dedup_latest(table(spark, sf_dir, "lineitem", spread_out=True), LINE_KEYS, ["l_shipdate"])


@register("duplicate_keys")
def duplicate_keys(spark, sf_dir):
    return frames.duplicate_keys(table(spark, sf_dir, "lineitem"), LINE_KEYS)


# --- upsert ----------------------------------------------------------------
# Orders up to 1997 are the stored table; orders from 1996 on arrive as the
# new batch with a changed price and status, so 1996-97 update, later insert.
ORDER_KEYS = ("o_orderkey",)


def order_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    year = F.year(F.col("o_orderdate"))
    target = orders.filter(year <= 1997)
    source = orders.filter(year >= 1996).select(
        "o_orderkey",
        "o_custkey",
        F.lit("U").alias("o_orderstatus"),
        (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    return target, source


@register("upsert_orders")
def upsert_orders(spark, sf_dir):
    target, source = order_batches(spark, sf_dir)
    return upsert.upsert(target, source, ORDER_KEYS)


@register("upsert_metrics")
def upsert_metrics(spark, sf_dir):
    target, source = order_batches(spark, sf_dir)
    return upsert.change_counts(upsert.merge_changes(target, source, ORDER_KEYS))


def null_key_batches(spark, sf_dir):
    target, source = order_batches(spark, sf_dir)

    def blank(df):
        return df.withColumn(
            "o_custkey", F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_custkey"))
        )

    return blank(target), blank(source)


@register("upsert_null_keys")
def upsert_null_keys(spark, sf_dir):
    target, source = null_key_batches(spark, sf_dir)
    return upsert.merge_changes(target, source, ("o_orderkey", "o_custkey"))


@register("upsert_null_safe")
def upsert_null_safe(spark, sf_dir):
    target, source = null_key_batches(spark, sf_dir)
    return upsert.merge_changes(target, source, ("o_orderkey", "o_custkey"), null_safe=True)


# --- workbooks: written from the tables on the executors, read back --------


def _inbox(spark) -> str:
    return scratch_dir(spark, "workbooks") + "/inbox"


def _write(df, folder) -> None:
    write_workbooks(df, folder).write.format("noop").mode("overwrite").save()


SUPPLIER_POSITIONS = (1, 3, 4, 6, 7)
SUPPLIER_NAMES = ("supp_id", "supp_name", "nation", "since", "name_inline")


def supplier_workbooks(spark, sf_dir, folder):
    """One workbook per nation, two sheets, twelve columns with the supplier
    fields at fixed positions among fillers and a gap."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    cells = F.array(
        cell("n", k),
        cell("n", k),
        cell("i", F.lit("x")),
        cell("s", F.col("s_name")),
        cell("n", F.col("s_nationkey")),
        F.lit(None),
        cell("d", F.date_add(F.lit("1995-01-01").cast("date"), k.cast("int"))),
        cell("i", F.concat(F.lit("  "), F.col("s_name"), F.lit(" "))),
        *[cell("n", k * i) for i in range(2, 6)],
    )
    _write(
        s.select(
            F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string"), F.lit(".xlsx")).alias("file"),
            F.concat(F.lit("part_"), (k % 2).cast("string")).alias("sheet"),
            k.alias("row_no"),
            cells.alias("cells"),
        ),
        folder,
    )


@register("workbook_roundtrip")
def workbook_roundtrip(spark, sf_dir):
    inbox = _inbox(spark)
    supplier_workbooks(spark, sf_dir, inbox)
    return wb.to_rows(wb.read_workbooks(spark, inbox), SUPPLIER_POSITIONS, SUPPLIER_NAMES, RUN_DATE)


@register("workbook_blank_rows")
def workbook_blank_rows(spark, sf_dir):
    """Suppliers in one workbook per nation, written every third row, with
    explicit empty rows between some and the nation cell left out for every
    fifth supplier."""
    inbox = _inbox(spark)
    sup = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    file = F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string"), F.lit(".xlsx")).alias("file")
    data = sup.select(
        file,
        F.lit("all").alias("sheet"),
        (key * 3 + 1).alias("row_no"),
        F.array(
            cell("n", key),
            cell("s", F.col("s_name")),
            cell("i", F.lit(" ")),
            F.when(key % 5 == 0, F.lit(None)).otherwise(cell("n", F.col("s_nationkey"))),
        ).alias("cells"),
    )
    empty = F.array(F.lit(None), F.lit(None)).cast("array<struct<t:string,v:string>>")
    blanks = sup.filter(key % 2 == 0).select(file, F.lit("all").alias("sheet"), (key * 3 + 2).alias("row_no"), empty.alias("cells"))
    _write(data.unionByName(blanks), inbox)
    return wb.to_rows(
        wb.read_workbooks(spark, inbox), (0, 1, 3), ("supp_id", "supp_name", "nation"), blank_as_null=True
    )


# --- drops: the same rows as JSON lines that Spark writes and reads ---------


def supplier_file() -> Column:
    return F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string"), F.lit(".xlsx")).alias("file")


REJECT_POSITIONS = (1, 3, 7)


@register("sheet_rejects")
def sheet_rejects(spark, sf_dir):
    """A file per region, a sheet per nation holding its suppliers; every
    third nation's sheet is five columns wide, too narrow for the layout."""
    inbox = _inbox(spark)
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    text = lambda count: F.array(*[(F.col("s_suppkey") + i).cast("string") for i in range(count)])
    drops.write_drop(
        j.select(
            F.concat(F.lit("region_"), F.col("n_regionkey").cast("string"), F.lit(".xlsx")).alias("file"),
            F.concat(F.lit("nation_"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("sheet"),
            F.col("n_nationkey").cast("int").alias("sheet_no"),
            (F.col("s_suppkey") + 1).alias("row_no"),
            F.when(F.col("n_nationkey") % 3 == 0, text(5)).otherwise(text(12)).alias("cells"),
        ),
        inbox,
    )
    rep = wb.sheet_report(drops.read_drop(spark, inbox), REJECT_POSITIONS)
    return rep.select(
        wb.lineage("path").alias("source_file"), "sheet", "width", "data_rows", "accepted"
    )


DROP_POSITIONS = (0, 1, 2)
DROP_NAMES = ("supp_id", "supp_name", "nation")
FIRST_DROP_NATIONS = 13  # nations 0..12 arrive first, the rest later


def supplier_drop(suppliers: DataFrame, folder: str) -> None:
    """One file per nation with its suppliers."""
    cells = F.array(F.col("s_suppkey").cast("string"), F.col("s_name"), F.col("s_nationkey").cast("string"))
    drops.write_drop(
        suppliers.select(
            supplier_file(),
            F.lit("suppliers").alias("sheet"),
            F.lit(0).alias("sheet_no"),
            (F.col("s_suppkey") + 1).alias("row_no"),
            cells.alias("cells"),
        ),
        folder,
    )


@register("ingest_report")
def ingest_report(spark, sf_dir):
    folder = scratch_dir(spark, "ingest")
    supplier_drop(table(spark, sf_dir, "supplier"), folder + "/inbox")
    cells = drops.read_drop(spark, folder + "/inbox")
    return bronze.ingest_cells(cells, DROP_POSITIONS, DROP_NAMES, folder + "/bronze", RUN_DATE).report


@register("ingest_same_names")
def ingest_same_names(spark, sf_dir):
    """Two ingests on one date whose files have the same names: each run's
    report holds its own rows only."""
    folder = scratch_dir(spark, "ingest-twice")
    sup = table(spark, sf_dir, "supplier")
    out = None
    for no, rows in ((1, sup), (2, sup.filter(F.col("s_nationkey") < FIRST_DROP_NATIONS))):
        supplier_drop(rows, f"{folder}/drop_{no}/inbox")
        cells = drops.read_drop(spark, f"{folder}/drop_{no}/inbox")
        res = bronze.ingest_cells(cells, DROP_POSITIONS, DROP_NAMES, folder + "/bronze", RUN_DATE)
        rep = res.report.select(F.lit(no).alias("run_no"), "source_file", "n_rows")
        out = rep if out is None else out.unionByName(rep)
    return out


@register("incremental_ingest")
def incremental_ingest(spark, sf_dir):
    """Two drops into one inbox; the second run must load only the new files."""
    folder = scratch_dir(spark, "incremental")
    inbox, target, ckpt = folder + "/inbox", folder + "/bronze", folder + "/checkpoint"
    sup = table(spark, sf_dir, "supplier")
    early = F.col("s_nationkey") < FIRST_DROP_NATIONS
    for rows in (sup.filter(early), sup.filter(~early)):
        supplier_drop(rows, inbox)
        incremental.ingest_new_drops(spark, inbox, DROP_POSITIONS, DROP_NAMES, target, ckpt)
    epoch = F.regexp_extract(bronze.RUN_COL, "_e([0-9]+)$", 1).cast("int").alias("ingest_epoch")
    return spark.read.parquet(target).select(*DROP_NAMES, "source_file", epoch)


@register("ingest_accounting")
def ingest_accounting(spark, sf_dir):
    """What became of every row of a drop: a file per region, a sheet per
    nation with a header line. Every third nation's sheet is too narrow; every
    fourth supplier's row ends before the last position, every tenth is blank."""
    folder = scratch_dir(spark, "accounting")
    n = table(spark, sf_dir, "nation").filter("n_nationkey is not null")
    j = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey")
    narrow = F.col("n_nationkey") % 3 == 0
    text = lambda count: F.array(*[(key + i).cast("string") for i in range(count)])
    blank = F.array_repeat(F.lit(" "), 12)
    place = [
        F.concat(F.lit("region_"), F.col("n_regionkey").cast("string"), F.lit(".xlsx")).alias("file"),
        F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string")).alias("sheet"),
        F.col("n_nationkey").cast("int").alias("sheet_no"),
    ]
    rows = j.select(
        *place,
        (key + 1).alias("row_no"),
        F.when(narrow, text(5)).when(key % 10 == 0, blank).when(key % 4 == 0, text(5)).otherwise(text(12)).alias("cells"),
    )
    headers = j.select(*place, narrow.alias("narrow")).distinct().select(
        "file", "sheet", "sheet_no", F.lit(0).cast("long").alias("row_no"),
        F.array_repeat(F.lit("title"), F.when(F.col("narrow"), 5).otherwise(12)).alias("cells"),
    )
    drops.write_drop(rows.unionByName(headers), folder + "/inbox")
    names = ("a", "b", "c")
    got = bronze.ingest_cells(drops.read_drop(spark, folder + "/inbox"), REJECT_POSITIONS, names, folder + "/raw", RUN_DATE)
    file = lambda c: F.element_at(F.split(c, "/"), -1).alias("source_file")
    kept = spark.read.parquet(folder + "/raw").groupBy(file("source_file")).agg(
        F.count(F.lit(1)).alias("kept"), F.count_if(F.col("c").isNull()).alias("kept_short")
    )
    rejected = spark.read.parquet(bronze.rejects_of(folder + "/raw")).groupBy(file("path")).agg(
        F.count_if(F.col("reason") == "narrow").alias("rejected_narrow"), F.sum(F.size("cells").cast("long")).alias("rejected_cells")
    )
    none = F.lit(0).cast("long")
    counts = ("kept", "kept_short", "rejected_narrow", "rejected_cells")
    return kept.join(rejected, "source_file", "full_outer").select(
        "source_file",
        *[F.coalesce(c, none).alias(c) for c in counts],
        F.lit(got.sheet_rows).alias("run_seen"),
        F.lit(got.rows).alias("run_kept"),
        F.lit(got.blank_rows).alias("run_blank"),
        F.lit(got.rejected_rows).alias("run_rejected"),
        F.lit(got.rejected_sheets).cast("long").alias("run_rejected_sheets"),
    )


def party_drop(parties: DataFrame, prefix: str, folder: str) -> None:
    """Suppliers or customers (``s_`` or ``c_`` columns) as one file per nation."""
    key, nation = ("suppkey" if prefix == "s_" else "custkey"), F.col(f"{prefix}nationkey")
    cells = F.array(F.col(prefix + key).cast("string"), F.col(f"{prefix}name"), nation.cast("string"))
    drops.write_drop(
        parties.select(
            F.concat(F.lit("nation_"), nation.cast("string")).alias("file"),
            F.lit("all").alias("sheet"),
            F.lit(0).alias("sheet_no"),
            (F.col(prefix + key) + 1).alias("row_no"),
            cells.alias("cells"),
        ),
        folder,
    )


@register("load_once")
def load_once(spark, sf_dir):
    """One raw table filled by two batch runs over a growing inbox, a batch run
    and a stream that find nothing new there, and two streams with checkpoints
    of their own over two more inboxes, all on one date and one manifest. Each
    row comes once, with the place of its run in the order of runs."""
    folder = scratch_dir(spark, "load-once")
    raw, manifest = folder + "/raw", Manifest(spark, folder + "/manifest")
    args = (DROP_POSITIONS, DROP_NAMES, raw)
    sup, cust = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")

    def batch():
        try:
            bronze.ingest_pending(spark, manifest, "suppliers", folder + "/a", *args, RUN_DATE, drop=True)
        except bronze.NothingToIngest:
            pass

    for rows in (sup.filter(F.col("s_nationkey") < FIRST_DROP_NATIONS), sup.filter(F.col("s_nationkey") >= FIRST_DROP_NATIONS)):
        party_drop(rows, "s_", folder + "/a")
        batch()
        batch()
    party_drop(cust.filter(F.col("c_nationkey") < FIRST_DROP_NATIONS), "c_", folder + "/b")
    party_drop(cust.filter(F.col("c_nationkey") >= FIRST_DROP_NATIONS), "c_", folder + "/c")
    for source, inbox in (("suppliers", "a"), ("customers", "b"), ("customers", "c")):
        incremental.ingest_new_drops(spark, f"{folder}/{inbox}", *args, f"{folder}/ckpt-{inbox}", RUN_DATE, manifest, source)
    stored = spark.read.parquet(raw)
    order = F.dense_rank().over(Window.orderBy(bronze.RUN_COL))  # a handful of runs
    runs_in_order = stored.select(bronze.RUN_COL).distinct().withColumn("run_no", order)
    return stored.join(runs_in_order, bronze.RUN_COL).select(*DROP_NAMES, "load_date", "run_no")


# --- layout: compaction, clustering, statistics ---------------------------


CLUSTER_COLS = ("l_partkey", "l_suppkey")
CLUSTER_FILES = 16
UPKEEP_YEAR = 1997


@register("compacted")
def compacted(spark, sf_dir):
    """Lineitem landed as 32 small files, compacted to ~256 KB files."""
    folder = scratch_dir(spark, "compact")
    table(spark, sf_dir, "lineitem").repartition(32).write.parquet(folder + "/small")
    layout.compact_path(spark, folder + "/small", folder + "/compact", file_bytes=256 * 1024)
    return spark.read.parquet(folder + "/compact")


def _zordered_path(spark, sf_dir) -> str:
    folder = scratch_dir(spark, "zorder")
    li = table(spark, sf_dir, "lineitem")
    layout.zorder(li, CLUSTER_COLS, CLUSTER_FILES).write.parquet(folder + "/z")
    return folder + "/z"


@register("zordered")
def zordered(spark, sf_dir):
    return spark.read.parquet(_zordered_path(spark, sf_dir))


@register("file_skipping")
def file_skipping(spark, sf_dir):
    """A point lookup per clustering column, on clustered and on plain files:
    rows that match, rows found in the files whose min/max admit the value,
    and whether the clustered layout opens no more files than the plain one."""
    clustered_path = _zordered_path(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem")
    folder = scratch_dir(spark, "plain")
    li.repartition(CLUSTER_FILES).write.parquet(folder + "/p")
    # the smallest value that is not below the column's mean
    means = li.agg(*[F.avg(c).alias(c) for c in CLUSTER_COLS]).first()
    lookups = li.agg(*[F.min(F.when(F.col(c) >= means[c], F.col(c))).alias(c) for c in CLUSTER_COLS]).first()
    out = None
    for c in CLUSTER_COLS:
        v = lookups[c]
        row = li.agg(F.lit(c).alias("column_name"), F.lit(v).alias("lookup"), F.count_if(F.col(c) == v).alias("matching"))
        for kind, path in (("clustered", clustered_path), ("plain", folder + "/p")):
            stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
            admitted = layout.file_ranges(spark.read.parquet(path), [c]).filter(layout.admits(c, v)).select("file")
            found = stored.filter(F.col(c) == v).join(admitted, "file", "left_semi")
            row = row.withColumn(f"found_{kind}", found.agg(F.count(F.lit(1))).scalar())
            row = row.withColumn(f"files_{kind}", admitted.agg(F.count(F.lit(1))).scalar())
        row = row.withColumn("clustered_opens_no_more", F.col("files_clustered") <= F.col("files_plain"))
        row = row.drop("files_clustered", "files_plain")
        out = row if out is None else out.unionByName(row)
    return out


@register("column_stats")
def column_stats(spark, sf_dir):
    folder = scratch_dir(spark, "stats")
    name = f"orders_stats_{uuid.uuid4().hex[:10]}"
    table(spark, sf_dir, "orders").write.option("path", folder + "/orders").format("parquet").saveAsTable(name)
    stats = layout.analyze_columns(spark, name, ["o_orderkey", "o_custkey"])
    return stats.select("col_name", "min_value", "max_value", "num_nulls")


@register("table_detail")
def table_detail(spark, sf_dir):
    """Columns and types of the stored orders table, as its detail lists them."""
    folder = scratch_dir(spark, "detail")
    name = f"orders_detail_{uuid.uuid4().hex[:10]}"
    orders = table(spark, sf_dir, "orders")
    tables.overwrite(orders, name, location=folder + "/orders")
    detail = tables.describe(spark, name)
    return detail.filter(F.col("col_name").isin(orders.columns)).select("col_name", "data_type")


@register("sketch_stats")
def sketch_stats(spark, sf_dir):
    """Statistics of the orders' columns merged from one load a year; the sketches
    are held against the exact counts (within 5 % of the distinct values, and of
    the ranks, where there are over 1,000)."""
    folder = scratch_dir(spark, "sketches")
    orders = table(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    year = F.year("o_orderdate")
    for r in orders.select(year.alias("y")).distinct().collect():  # a handful of loads
        statistics.record(orders.filter(year.eqNullSafe(F.lit(r.y))), cols, folder, str(r.y))
    merged = statistics.summary(statistics.merge(statistics.recorded(spark, folder)))
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in cols]).unpivot([], cols, "col_name", "exact")
    q = {r.col_name: r.quantiles for r in merged.collect()}
    ranks = orders.agg(
        *[
            (F.greatest(*[F.abs(F.avg((F.col(c) <= v).cast("double")) - p) for p, v in zip((0.25, 0.5, 0.75), q[c])]) if q[c] else F.lit(None).cast("double")).alias(c)
            for c in cols
        ]
    ).unpivot([], cols, "col_name", "off")
    near = F.abs(F.col("distinct_estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.05)
    return merged.join(exact, "col_name").join(ranks, "col_name").select(
        "col_name", "n_rows", "num_nulls",
        F.when(F.col("col_name") != "o_totalprice", F.col("min_value")).alias("min_value"),
        F.when(F.col("col_name") != "o_totalprice", F.col("max_value")).alias("max_value"),
        near.alias("distinct_near"),
        F.coalesce((F.col("off") < 0.05) | (F.col("n_rows") < 1000), F.lit(True)).alias("ranks_near"),
    )


@register("table_files")
def table_files(spark, sf_dir):
    """Detail of the orders stored by year, from its files: what is counted over
    the listing must be what the data says (one file a year, all bytes in files)."""
    folder, name = scratch_dir(spark, "table_files"), f"orders_files_{uuid.uuid4().hex[:10]}"
    orders = table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    tables.overwrite(orders.repartition("o_year"), name, ["o_year"], location=folder + "/t")
    per_part = tables.files(spark, name).groupBy("partition").agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("part_bytes"))
    whole = tables.detail(spark, name)
    rows = spark.table(name).groupBy(F.concat(F.lit("o_year="), F.col("o_year").cast("string")).alias("partition")).agg(F.count(F.lit(1)).alias("n_rows"))
    total = per_part.agg(F.sum("part_bytes")).scalar()
    of = lambda c: whole.select(c).scalar()
    return per_part.join(rows, "partition").select(
        "partition", "n_files", "n_rows", of("partitions").alias("partitions"), of("files").alias("files"),
        (of("bytes") == total).alias("bytes_add_up"), of("versions").alias("versions"),
    )


def _grown_table(spark, rows: DataFrame, key: str, year: str, appends: int, folder: str, first: DataFrame) -> str:
    """A table by ``year``: the years before ``UPKEEP_YEAR`` as ``first`` lays them out, the others in ``appends`` loads."""
    name = f"upkeep_{uuid.uuid4().hex[:10]}"
    tables.overwrite(first.where(F.col(year) < UPKEEP_YEAR), name, [year], location=folder + "/t")
    load = F.pmod(F.xxhash64(key), F.lit(appends))
    for k in range(appends):
        tables.append(rows.where((F.col(year) >= UPKEEP_YEAR) & (load == k)).repartition(year), name)
    tables.files(spark, name).select("partition", "file").write.parquet(folder + "/before")
    return name


def _files_kept(spark, name: str, folder: str, year: str) -> DataFrame:
    """Per partition: rows, files, and how many of the files were there before the upkeep."""
    before = spark.read.parquet(folder + "/before").withColumn("was", F.lit(1))
    rows = spark.table(name).groupBy(F.concat(F.lit(year + "="), F.col(year).cast("string")).alias("partition")).agg(F.count(F.lit(1)).alias("n_rows"))
    per_part = (
        tables.files(spark, name)
        .join(before, ["partition", "file"], "left")
        .groupBy("partition")
        .agg(F.count(F.lit(1)).alias("n_files"), F.count("was").alias("files_kept"))
    )
    return rows.join(per_part, "partition")


@register("compacted_partitions")
def compacted_partitions(spark, sf_dir):
    """Orders by year, the later years in four loads: their files are packed, those of the other years stay."""
    folder = scratch_dir(spark, "compact_partitions")
    orders = table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    name = _grown_table(spark, orders, "o_orderkey", "o_year", 4, folder, orders.repartition("o_year"))
    maintenance.compact_partitions(spark, name)
    return _files_kept(spark, name, folder, "o_year").select("partition", "n_rows", "n_files", "files_kept")


@register("reclustered_partitions")
def reclustered_partitions(spark, sf_dir):
    """Lineitem by year, clustered by part; the later years in five loads that each hold all parts.
    Only those years are clustered again; then a lookup opens two files of a year at most."""
    folder = scratch_dir(spark, "recluster_partitions")
    li = table(spark, sf_dir, "lineitem").withColumn("l_year", F.year("l_shipdate"))
    first = li.repartitionByRange(24, "l_year", "l_partkey").sortWithinPartitions("l_year", "l_partkey")
    name = _grown_table(spark, li, "l_orderkey", "l_year", 5, folder, first)
    deep = maintenance.overlap(spark, name, ["l_partkey"])
    deep.select(F.concat(F.lit("l_year="), F.col("l_year").cast("string")).alias("partition"), (F.col("depth") > 2).alias("deep_before")).write.parquet(folder + "/deep")
    maintenance.recluster_partitions(spark, name, ["l_partkey"], tables.stored_bytes(spark, folder + "/t") // 24)
    after = maintenance.overlap(spark, name, ["l_partkey"]).select(
        F.concat(F.lit("l_year="), F.col("l_year").cast("string")).alias("partition"), (F.col("depth") <= 2).alias("narrow")
    )
    kept = _files_kept(spark, name, folder, "l_year").withColumn("files_stay", F.col("files_kept") == F.col("n_files"))
    return kept.join(spark.read.parquet(folder + "/deep"), "partition").join(after, "partition").select(
        "partition", "n_rows", "deep_before", "narrow", "files_stay"
    )


# --- runs: ledger gate, replay ---------------------------------------------

MEMBER_EVENTS = ("signup", "purchase")
HOLDER_EVENTS = ("view", "click")
RUN_SECONDS = 600


def events_ledger(spark, sf_dir):
    """A ledger as the raw layer would publish it, one run per 10 minutes of
    events: members/holders rows loaded; a run with only error events was an
    on-demand replay (both -1); a run with no event loaded nothing (0)."""
    ev = table(spark, sf_dir, "events")
    ts = F.col("ts")
    sec = (
        F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )
    bucket = F.floor(sec / RUN_SECONDS).alias("run_id")
    et = F.col("event_type")
    per_run = ev.groupBy(bucket).agg(
        F.count_if(et.isin(list(MEMBER_EVENTS))).alias("m"),
        F.count_if(et.isin(list(HOLDER_EVENTS))).alias("h"),
        F.count_if(et == "error").alias("e"),
        F.count(F.lit(1)).alias("n"),
    )
    # the calendar of runs, also without events: one row per day, exploded into its runs
    span = ev.agg(F.min(bucket).alias("lo"), F.max(bucket).alias("hi")).first()
    lo, hi = (span["lo"], span["hi"]) if span["lo"] is not None else (0, -1)
    calendar = spark.range(lo, hi + 1).withColumnRenamed("id", "run_id")
    r = calendar.join(per_run, "run_id", "left")
    on_demand = F.coalesce((F.col("e") == F.col("n")), F.lit(False))
    m = F.when(on_demand, F.lit(runs.ON_DEMAND)).otherwise(F.coalesce("m", F.lit(0)))
    h = F.when(on_demand, F.lit(runs.ON_DEMAND)).otherwise(F.coalesce("h", F.lit(0)))
    return r.select(
        "run_id",
        F.explode(F.array(F.struct(F.lit("members").alias("feed"), m.cast("long").alias("rows")),
                          F.struct(F.lit("holders").alias("feed"), h.cast("long").alias("rows")))).alias("x"),
    ).select("run_id", "x.feed", "x.rows")


@register("run_dates")
def run_dates(spark, sf_dir):
    """Events per run date: the date of each event on the run zone's calendar,
    and how many of them have that date when its text is read back; texts of
    other spellings give no date."""
    ev = table(spark, sf_dir, "events")
    day = C.local_date(F.col("ts").cast("timestamp"), runs.RUN_ZONE)
    text = F.when(F.col("event_id") % 5 == 0, F.date_format("run_date", "dd/MM/yyyy")).otherwise(
        F.date_format("run_date", "yyyy-MM-dd")
    )
    dated = ev.select("event_id", day.alias("run_date")).withColumn("read", C.run_date_of(text))
    return dated.groupBy("run_date").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("read") == F.col("run_date")).alias("n_read")
    )


@register("new_rows_gate")
def new_rows_gate(spark, sf_dir):
    return runs.gate(events_ledger(spark, sf_dir))


@register("replay_date")
def replay_date(spark, sf_dir):
    return runs.replay(members_raw(spark, sf_dir), SLICE_DATE)


@register("replay_holders")
def replay_holders(spark, sf_dir):
    return runs.replay(holders_raw(spark, sf_dir), SLICE_DATE, "holders")


# --- all layers ------------------------------------------------------------


def feed_drop(raw: DataFrame, feed: medallion.Feed, folder: str, dealt: bool = False, compression: str | None = None) -> None:
    """Raw feed rows laid out at the feed's column positions, fillers elsewhere."""
    slots = dict(zip(feed.positions, feed.raw_columns))
    cells = F.array(*[F.col(slots[i]) if i in slots else F.lit(str(i)) for i in range(feed.min_width)])
    drops.write_drop(
        raw.select(
            F.element_at(F.split("source_file", "/"), -1).alias("file"),
            F.concat(F.lit("S"), F.col("sheet_no").cast("string")).alias("sheet"),
            "sheet_no",
            "row_no",
            cells.alias("cells"),
        ),
        folder,
        dealt,
        compression,
    )


@register("layers_end_to_end")
def layers_end_to_end(spark, sf_dir):
    folder = scratch_dir(spark, "layers")
    lines = drops.deal(table(spark, sf_dir, "lineitem"), F.trunc(F.col("l_shipdate").cast("date"), "month"))
    feed_drop(feeds.members_raw(lines), medallion.MEMBERS, folder + "/inbox/members", dealt=True, compression="gzip")
    feed_drop(holders_raw(spark, sf_dir), medallion.HOLDERS, folder + "/inbox/holders", compression="gzip")
    tag = uuid.uuid4().hex[:8]
    cfg = runs.PipelineConfig(
        members_inbox=folder + "/inbox/members",
        holders_inbox=folder + "/inbox/holders",
        members_raw=folder + "/raw/members",
        holders_raw=folder + "/raw/holders",
        members_table=f"members_clean_{tag}",
        holders_table=f"holders_clean_{tag}",
        gold_table=f"report_{tag}",
        ledger=folder + "/ledger",
        history=folder + "/history",
        table_root=folder + "/tables",
        drops=True,
    )
    runs.run_all(spark, cfg, RUN_DATE)
    return spark.table(cfg.gold_table)


@register("merge_history")
def merge_history(spark, sf_dir):
    """What the first load and a merge into the year-partitioned orders table record."""
    target, source = order_batches(spark, sf_dir)
    year = F.year("o_orderdate").alias("o_year")
    name = f"orders_history_{uuid.uuid4().hex[:10]}"
    folder = scratch_dir(spark, "merge_history")
    keys, parts = ("o_orderkey", "o_year"), ("o_year",)
    for rows in (target, source):
        upsert.upsert_partitions(
            rows.select("*", year), name, keys, parts, location=folder + "/t", history=folder + "/h"
        )
    return spark.read.parquet(folder + "/h").select("mode", "inserted", "updated", "total")


@register("upsert_by_partition")
def upsert_by_partition(spark, sf_dir):
    """The orders upsert stored partitioned by order year (part of the key):
    the merge rewrites only the years the new batch touches."""
    target, source = order_batches(spark, sf_dir)
    year = F.year("o_orderdate").alias("o_year")
    name = f"orders_by_year_{uuid.uuid4().hex[:10]}"
    loc = scratch_dir(spark, "orders_by_year")
    keys, parts = ("o_orderkey", "o_year"), ("o_year",)
    upsert.upsert_partitions(target.select("*", year), name, keys, parts, location=loc)
    upsert.upsert_partitions(source.select("*", year), name, keys, parts)
    spark.catalog.refreshTable(name)
    return spark.table(name)


@register("upsert_bucketed")
def upsert_bucketed(spark, sf_dir):
    """The same upsert into a table that is also bucketed by order: the merge
    does not shuffle the stored side, and the result is bucketed again."""
    target, source = order_batches(spark, sf_dir)
    year = F.year("o_orderdate").alias("o_year")
    name = f"orders_bucketed_{uuid.uuid4().hex[:10]}"
    loc = scratch_dir(spark, "orders_bucketed")
    keys, parts = ("o_orderkey", "o_year"), ("o_year",)
    buckets = upsert.Buckets(upsert.bucket_count(target.count(), 8), ("o_orderkey",))
    for rows in (target, source):
        upsert.upsert_partitions(rows.select("*", year), name, keys, parts, location=loc, buckets=buckets)
    return spark.table(name)


def clean_buckets(spark, sf_dir) -> upsert.Buckets:
    """How both clean tables are dealt: alike, so that they join where they lie, and by the larger one's rows."""
    rows = max(table(spark, sf_dir, t).count() for t in ("lineitem", "orders"))  # from the files' footers
    return upsert.Buckets(upsert.bucket_count(rows, 8), ("policy_id",))


def bucketed_clean(spark, sf_dir) -> tuple[str, str]:
    """Both clean tables by period, dealt by policy."""
    folder, tag = scratch_dir(spark, "clean_bucketed"), uuid.uuid4().hex[:10]
    buckets, made = clean_buckets(spark, sf_dir), []
    for feed, clean, raw in (
        (medallion.MEMBERS, medallion.clean_members, members_raw),
        (medallion.HOLDERS, medallion.clean_holders, holders_raw),
    ):
        name = f"{feed.name}_bucketed_{tag}"
        # equal rows share a bucket, so they are made one there, by the one exchange
        rows = clean(raw(spark, sf_dir), RUN_DATE, distinct=False).repartition(buckets.n, *buckets.columns).distinct()
        w = rows.write.partitionBy(*runs.PERIOD).bucketBy(buckets.n, *buckets.columns).sortBy(*buckets.columns)
        w.option("path", f"{folder}/{feed.name}").format("parquet").saveAsTable(name)
        made.append(name)
    return tuple(made)


@register("gold_bucketed")
def gold_bucketed(spark, sf_dir):
    """The report's join over clean tables that are both dealt by policy: no shuffle at all."""
    members, holders = bucketed_clean(spark, sf_dir)
    return medallion.consolidate(spark.table(members), spark.table(holders))


@register("gold_incremental")
def gold_incremental(spark, sf_dir):
    """Three overlapping loads by movement month, each merged into the clean
    tables and brought into the report by its policies."""
    folder, tag = scratch_dir(spark, "gold_incremental"), uuid.uuid4().hex[:10]
    members, holders, gold = (f"{n}_{tag}" for n in ("m_inc", "h_inc", "g_inc"))
    buckets = clean_buckets(spark, sf_dir)
    arrival = ("source_file", "sheet_no", "row_no")
    for load, months in enumerate(((1, 6), (5, 9), (9, 12))):
        for feed, clean, raw, name in (
            (medallion.MEMBERS, medallion.clean_members, members_raw, members),
            (medallion.HOLDERS, medallion.clean_holders, holders_raw, holders),
        ):
            rows = clean(raw(spark, sf_dir), RUN_DATE, distinct=False, carry=arrival)
            batch = rows.filter(F.col("mov_month").between(*months) | F.col("mov_month").isNull())

            def note(merged: DataFrame, run: str = f"{feed.name}-{load}") -> None:
                with upsert.dealt_alike(spark, buckets):
                    report.note_changes(merged, folder + "/changes", run)

            upsert.upsert_partitions(
                batch, name, feed.keys, runs.PERIOD, on_duplicate="latest", order_by=arrival, drop_columns=arrival,
                location=f"{folder}/{name}", buckets=buckets, merged=note,
            )
        report.refresh_changed(spark, members, holders, gold, folder + "/changes", parts=16, location=f"{folder}/{gold}")
    return spark.table(gold).select(*medallion.GOLD_COLUMNS)


@register("member_rejects")
def member_rejects(spark, sf_dir):
    return medallion.member_rejects(members_raw(spark, sf_dir))


@register("holder_rejects")
def holder_rejects(spark, sf_dir):
    return medallion.holder_rejects(holders_raw(spark, sf_dir))

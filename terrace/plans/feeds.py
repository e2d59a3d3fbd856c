"""Raw (all-text) feeds derived by Spark from the warehouse tables.

There are no workbooks in the test data, so the raw members and holders
feeds are produced from ``lineitem`` and ``orders ⋈ customer`` with the same
kinds of dirt real workbooks carry: ids with decimal tails, dates in eight
spellings, quoted document numbers, blank name parts. Every input row yields
exactly one raw row; nothing is sampled or filtered here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings a date cell may arrive in; the index is chosen per row.
DATE_SPELLINGS = (
    "yyyy-MM-dd",
    "dd/MM/yyyy",
    "dd-MM-yyyy",
    "yyyy/MM/dd",
    "yyyyMMdd",
    "dd/MM/yy",
    "yyyy-MM-dd' 00:00:00'",
    None,  # unparseable text
)
BAD_DATE = "bad"


def spell_date(d: Column, selector: Column) -> Column:
    """Render date ``d`` in the spelling picked by ``selector`` (0..7)."""
    expr = None
    for i, fmt in enumerate(DATE_SPELLINGS):
        val = F.date_format(d, fmt) if fmt else F.lit(BAD_DATE)
        expr = F.when(selector == i, val) if expr is None else expr.when(selector == i, val)
    return expr


def members_raw(lineitem: DataFrame) -> DataFrame:
    """Members feed, one row per line item, bronze column order."""
    dt = F.col("l_shipdate").cast("date")
    pk = F.col("l_partkey")
    line = F.col("l_linenumber")
    policy = F.when(F.col("l_orderkey") % 97 == 0, F.lit("N/A")).otherwise(
        F.concat(
            F.col("l_orderkey").cast("string"),
            F.when(line % 3 == 0, "").when(line % 3 == 1, ".0").otherwise(".00"),
        )
    )
    base = pk + 10000
    sk = F.col("l_suppkey") % 4
    doc = (
        F.when(sk == 0, F.concat(F.lit("'"), base.cast("string")))
        .when(sk == 1, F.concat(base.cast("string"), F.lit("_")))
        .when(sk == 2, F.concat(F.lit('"'), (pk + 12340000).cast("string"), F.lit('"')))
        .otherwise(F.concat(F.lit("X"), pk.cast("string")))
    )
    return lineitem.select(
        policy.alias("policy_id"),
        spell_date(F.date_sub(dt, 30), (pk + 1) % 8).alias("policy_start"),
        spell_date(F.date_add(dt, 335), (pk + 2) % 8).alias("policy_end"),
        line.cast("string").alias("certificate"),
        spell_date(dt, pk % 8).alias("cover_start"),
        spell_date(F.date_add(dt, 30), (pk + 3) % 8).alias("cover_end"),
        F.when(line % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("l_returnflag")).alias("first_name"),
        F.col("l_linestatus").alias("second_name"),
        F.lit("  ").alias("surname_1"),
        F.col("l_returnflag").alias("surname_2"),
        line.cast("string").alias("doc_type"),
        doc.alias("doc_no"),
        F.year(dt).cast("string").alias("mov_year"),
        F.concat(F.month(dt).cast("string"), F.lit(".0")).alias("mov_month"),
        F.concat(F.lit("./members/batch_"), F.date_format(dt, "yyyyMM"), F.lit(".xlsx")).alias("source_file"),
        F.make_date(F.year(dt), F.month(dt), F.lit(1)).alias("load_date"),
        (F.col("l_orderkey") % 2).cast("int").alias("sheet_no"),
        (pk * 1000 + F.col("l_suppkey") % 1000 + 1).cast("long").alias("row_no"),
    )


def holders_raw(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Holders feed, one row per order, bronze column order."""
    ok = F.col("o_orderkey")
    ck = F.col("c_custkey")
    od = F.col("o_orderdate").cast("date")
    tail = F.when(ok % 2 == 0, F.lit(".0")).otherwise(F.lit(""))
    code = F.when(ck % 3 == 0, "1").when(ck % 3 == 1, "6").otherwise("9")
    c4 = ck % 4
    doc = (
        F.when(c4 == 0, F.concat(F.lit("'"), (ck + 100000).cast("string")))
        .when(c4 == 1, F.concat((ck + 100000).cast("string"), F.lit("_")))
        .when(c4 == 2, F.concat(F.lit("2"), F.lpad(ck.cast("string"), 10, "0")))
        .otherwise(F.concat(F.lit("C"), ck.cast("string")))
    )
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    return joined.select(
        F.concat(code, tail).alias("doc_type"),
        doc.alias("holder_doc_no"),
        F.when(ck % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("holder_name"),
        F.when(ok % 89 == 0, F.lit("")).otherwise(ok.cast("string")).alias("policy_id"),
        F.year(od).cast("string").alias("mov_year"),
        F.concat(F.month(od).cast("string"), tail).alias("mov_month"),
        F.concat(F.lit("./holders/batch_"), F.date_format(od, "yyyyMM"), F.lit(".xlsx")).alias("source_file"),
        F.make_date(F.year(od), F.month(od), F.lit(1)).alias("load_date"),
        F.lit(0).alias("sheet_no"),
        (ok + 1).cast("long").alias("row_no"),
    )

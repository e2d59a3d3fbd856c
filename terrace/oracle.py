"""Independent DuckDB SQL for every registered query.

The raw feeds are re-derived here in DuckDB's own dialect from the same
parquet tables, then each clean-up rule is written out again as plain SQL.
Nothing here calls Spark; the driver runs these strings next to the Spark
queries and compares row counts, schemas and values.
"""

from __future__ import annotations

# DuckDB strftime spellings, in the order of terrace.plans.feeds.DATE_SPELLINGS.
_SPELL = ("%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y", "%Y/%m/%d", "%Y%m%d", "%d/%m/%y")


def spell_sql(d: str, sel: str) -> str:
    arms = " ".join(f"WHEN {i} THEN strftime({d}, '{f}')" for i, f in enumerate(_SPELL))
    return f"(CASE {sel} {arms} WHEN 6 THEN strftime({d}, '%Y-%m-%d') || ' 00:00:00' ELSE 'bad' END)"


def parse_date_sql(x: str) -> str:
    """First 10 characters; each pattern guarded by an exact digit shape,
    since DuckDB's strptime accepts unpadded fields; two-digit years → 20yy."""
    s = f"substr({x}, 1, 10)"
    d2, d4 = "[0-9]{2}", "[0-9]{4}"
    arms = [
        (f"{d4}-{d2}-{d2}", f"try_strptime({s}, '%Y-%m-%d')"),
        (f"{d2}/{d2}/{d4}", f"try_strptime({s}, '%d/%m/%Y')"),
        (f"{d2}-{d2}-{d4}", f"try_strptime({s}, '%d-%m-%Y')"),
        (f"{d4}/{d2}/{d2}", f"try_strptime({s}, '%Y/%m/%d')"),
        ("[0-9]{8}", f"try_strptime({s}, '%Y%m%d')"),
        (
            f"{d2}/{d2}/{d2}",
            f"try_strptime('20' || substr({s}, 7, 2) || '-' || substr({s}, 4, 2) || '-' || substr({s}, 1, 2), '%Y-%m-%d')",
        ),
    ]
    cases = ", ".join(f"CASE WHEN regexp_full_match({s}, '{rx}') THEN CAST({e} AS DATE) END" for rx, e in arms)
    return f"coalesce({cases})"


def via_decimal_sql(x: str, precision: int, to: str) -> str:
    # DuckDB rounds decimal → integer; the rule truncates, hence trunc().
    return f"CAST(trunc(try_cast({x} AS DECIMAL({precision},2))) AS {to})"


def via_integer_sql(x: str) -> str:
    return f"try_cast(nullif(regexp_extract(trim({x}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1), '') AS INTEGER)"


def pad_sql(x: str, extra: str = "TRUE") -> str:
    return f"(CASE WHEN length({x}) IN (5, 6, 7) AND regexp_full_match({x}, '[0-9]+') AND {extra} THEN lpad({x}, 8, '0') ELSE {x} END)"


def strip_doc_sql(x: str) -> str:
    return f"translate({x}, '''\"_', '')"


MEMBERS_RAW = f"""
members_raw AS (
  SELECT
    CASE WHEN l_orderkey % 97 = 0 THEN 'N/A'
         ELSE CAST(l_orderkey AS VARCHAR) || CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN '.0' ELSE '.00' END
    END AS policy_id,
    {spell_sql("dt - 30", "(l_partkey + 1) % 8")} AS policy_start,
    {spell_sql("dt + 335", "(l_partkey + 2) % 8")} AS policy_end,
    CAST(l_linenumber AS VARCHAR) AS certificate,
    {spell_sql("dt", "l_partkey % 8")} AS cover_start,
    {spell_sql("dt + 30", "(l_partkey + 3) % 8")} AS cover_end,
    CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_returnflag END AS first_name,
    l_linestatus AS second_name,
    '  ' AS surname_1,
    l_returnflag AS surname_2,
    CAST(l_linenumber AS VARCHAR) AS doc_type,
    CASE l_suppkey % 4
      WHEN 0 THEN '''' || CAST(l_partkey + 10000 AS VARCHAR)
      WHEN 1 THEN CAST(l_partkey + 10000 AS VARCHAR) || '_'
      WHEN 2 THEN '"' || CAST(l_partkey + 12340000 AS VARCHAR) || '"'
      ELSE 'X' || CAST(l_partkey AS VARCHAR)
    END AS doc_no,
    CAST(year(dt) AS VARCHAR) AS mov_year,
    CAST(month(dt) AS VARCHAR) || '.0' AS mov_month,
    './members/batch_' || strftime(dt, '%Y%m') || '.xlsx' AS source_file,
    make_date(year(dt), month(dt), 1) AS load_date,
    l_orderkey % 2 AS sheet_no, l_partkey * 1000 + l_suppkey % 1000 AS row_no
  FROM (SELECT *, CAST(l_shipdate AS DATE) AS dt FROM lineitem)
)"""

HOLDERS_RAW = """
holders_raw AS (
  SELECT
    CASE c_custkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '6' ELSE '9' END
      || CASE WHEN o_orderkey % 2 = 0 THEN '.0' ELSE '' END AS doc_type,
    CASE c_custkey % 4
      WHEN 0 THEN '''' || CAST(c_custkey + 100000 AS VARCHAR)
      WHEN 1 THEN CAST(c_custkey + 100000 AS VARCHAR) || '_'
      WHEN 2 THEN '2' || lpad(CAST(c_custkey AS VARCHAR), 10, '0')
      ELSE 'C' || CAST(c_custkey AS VARCHAR)
    END AS holder_doc_no,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS holder_name,
    CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS policy_id,
    CAST(year(od) AS VARCHAR) AS mov_year,
    CAST(month(od) AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN '.0' ELSE '' END AS mov_month,
    './holders/batch_' || strftime(od, '%Y%m') || '.xlsx' AS source_file,
    make_date(year(od), month(od), 1) AS load_date,
    0 AS sheet_no, o_orderkey AS row_no
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS od FROM orders) o
  JOIN customer c ON o.o_custkey = c.c_custkey
)"""

RUN_DATE = "2026-01-15"
SLICE_DATE = "1998-06-01"


def members_clean_sql(where: str = "TRUE", run_date: str = RUN_DATE) -> str:
    d = strip_doc_sql("doc_no")
    return f"""
members_typed AS (
  SELECT
    {via_decimal_sql("policy_id", 20, "BIGINT")} AS policy_id,
    {parse_date_sql("policy_start")} AS policy_start,
    {parse_date_sql("policy_end")} AS policy_end,
    certificate,
    {parse_date_sql("cover_start")} AS cover_start,
    {parse_date_sql("cover_end")} AS cover_end,
    CASE {via_decimal_sql("doc_type", 10, "INTEGER")} WHEN 1 THEN 'DNI' WHEN 2 THEN 'CE' WHEN 5 THEN 'PAS' ELSE 'OTROS' END AS doc_type,
    {pad_sql(d)} AS doc_no,
    try_cast(right({d}, 1) AS INTEGER) AS doc_last_digit,
    replace(trim(concat_ws(' ', first_name, second_name, surname_1, surname_2)), '  ', ' ') AS member_name,
    {via_decimal_sql("mov_year", 10, "INTEGER")} AS mov_year,
    {via_decimal_sql("mov_month", 10, "INTEGER")} AS mov_month,
    DATE '{run_date}' AS load_date, source_file, sheet_no, row_no
  FROM members_raw WHERE {where}
),
members_clean AS (
  SELECT DISTINCT * EXCLUDE (source_file, sheet_no, row_no) FROM members_typed WHERE policy_id IS NOT NULL
)"""


def holders_clean_sql(where: str = "TRUE", run_date: str = RUN_DATE) -> str:
    d = strip_doc_sql("holder_doc_no")
    label = f"CASE {via_integer_sql('doc_type')} WHEN 1 THEN 'DNI' WHEN 6 THEN 'RUC' ELSE 'OTRO' END"
    return f"""
holders_typed AS (
  SELECT
    {via_decimal_sql("policy_id", 20, "BIGINT")} AS policy_id,
    {label} AS doc_type,
    {pad_sql(d, f"({label}) = 'DNI'")} AS holder_doc_no,
    holder_name,
    {via_integer_sql("mov_year")} AS mov_year,
    {via_integer_sql("mov_month")} AS mov_month,
    DATE '{run_date}' AS load_date, source_file, sheet_no, row_no
  FROM holders_raw WHERE {where}
),
holders_clean AS (
  SELECT DISTINCT * EXCLUDE (source_file, sheet_no, row_no) FROM holders_typed WHERE policy_id IS NOT NULL AND holder_name IS NOT NULL
)"""


GOLD_SELECT = """
  SELECT DISTINCT m.policy_id, m.policy_start, m.policy_end, m.cover_start, m.cover_end,
         h.holder_doc_no, h.holder_name, m.doc_type, m.doc_no, m.doc_last_digit, m.member_name
  FROM members_clean m LEFT JOIN holders_clean h ON {cond}"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["silver_members"] = with_(MEMBERS_RAW, members_clean_sql()) + "SELECT * FROM members_clean"
    q["silver_holders"] = with_(HOLDERS_RAW, holders_clean_sql()) + "SELECT * FROM holders_clean"
    gold_ctes = with_(MEMBERS_RAW, members_clean_sql(), HOLDERS_RAW, holders_clean_sql())
    q["gold_consolidated"] = gold_ctes + GOLD_SELECT.format(cond="m.policy_id = h.policy_id")
    q["gold_salted"] = q["gold_consolidated"]
    q["gold_heavy_hitters"] = q["gold_consolidated"]
    q["gold_by_period"] = gold_ctes + GOLD_SELECT.format(
        cond="m.policy_id = h.policy_id AND m.mov_year = h.mov_year AND m.mov_month = h.mov_month"
    )
    m = with_(MEMBERS_RAW)
    h = with_(HOLDERS_RAW)
    doc = strip_doc_sql("doc_no")
    q["clean_doc_numbers"] = m + f"""
  SELECT doc_no, {doc} AS doc_clean, try_cast(right({doc}, 1) AS INTEGER) AS doc_last_digit,
         trim(surname_1 || surname_2 || surname_1) AS surname_trimmed
  FROM members_raw"""
    q["pad_doc_any"] = m + f"SELECT doc_no, {pad_sql(doc)} AS doc_padded FROM members_raw"
    hdoc = strip_doc_sql("holder_doc_no")
    hlabel = f"(CASE {via_integer_sql('doc_type')} WHEN 1 THEN 'DNI' WHEN 6 THEN 'RUC' ELSE 'OTRO' END)"
    q["pad_doc_typed"] = h + f"""
  SELECT holder_doc_no, {hlabel} AS doc_label, {pad_sql(hdoc, f"{hlabel} = 'DNI'")} AS doc_padded
  FROM holders_raw"""
    q["whole_number_decimal"] = m + f"""
  SELECT policy_id, {via_decimal_sql("policy_id", 20, "BIGINT")} AS policy_wide,
         {via_decimal_sql("policy_id", 10, "BIGINT")} AS policy_narrow,
         mov_month, {via_decimal_sql("mov_month", 10, "INTEGER")} AS month_int
  FROM members_raw"""
    q["whole_number_int"] = h + f"""
  SELECT doc_type, {via_integer_sql("doc_type")} AS doc_type_int, mov_month,
         {via_integer_sql("mov_month")} AS month_int, {via_integer_sql("mov_year")} AS year_int
  FROM holders_raw"""
    dcols = ("policy_start", "policy_end", "cover_start", "cover_end")
    q["parse_dates"] = m + "SELECT " + ", ".join(
        [f"{c} AS {c}_text" for c in dcols] + [f"{parse_date_sql(c)} AS {c}" for c in dcols]
    ) + " FROM members_raw"
    parts = "first_name, second_name, surname_1, surname_2"
    q["full_name"] = m + f"""
  SELECT {parts},
         replace(trim(concat_ws(' ', {parts})), '  ', ' ') AS member_name,
         regexp_replace(trim(concat_ws(' ', {parts})), ' +', ' ', 'g') AS member_name_collapsed
  FROM members_raw"""
    q["label_codes"] = h + f"""
  SELECT doc_type,
         CASE {via_decimal_sql("doc_type", 10, "INTEGER")} WHEN 1 THEN 'DNI' WHEN 2 THEN 'CE' WHEN 5 THEN 'PAS' ELSE 'OTROS' END AS member_label,
         {hlabel} AS holder_label
  FROM holders_raw"""
    unp = lambda c, parsed: f"count(*) FILTER (WHERE {c} IS NOT NULL AND {parsed} IS NULL) AS {c}_unparsed"
    q["member_rejects"] = m + "SELECT count(*) AS rows, " + ", ".join(
        [unp("policy_id", via_decimal_sql("policy_id", 20, "BIGINT"))]
        + [unp(c, parse_date_sql(c)) for c in dcols]
        + [unp(c, via_decimal_sql(c, 10, "INTEGER")) for c in ("mov_year", "mov_month")]
    ) + " FROM members_raw"
    q["holder_rejects"] = h + "SELECT count(*) AS rows, " + ", ".join(
        [unp("policy_id", via_decimal_sql("policy_id", 20, "BIGINT"))]
        + [unp(c, via_integer_sql(c)) for c in ("doc_type", "mov_year", "mov_month")]
        + ["count(*) FILTER (WHERE holder_name IS NULL) AS holder_name_missing"]
    ) + " FROM holders_raw"
    q["load_slice"] = m + f"""
  SELECT policy_id, policy_start, policy_end, certificate, cover_start, cover_end, first_name, second_name,
         surname_1, surname_2, doc_type, doc_no, mov_year, mov_month, source_file, load_date,
         DATE '{RUN_DATE}' AS run_date
  FROM members_raw WHERE load_date = DATE '{SLICE_DATE}'"""
    q["required_keys"] = h + f"""
  SELECT * FROM (
    SELECT {via_decimal_sql("policy_id", 20, "BIGINT")} AS policy_id, holder_name, holder_doc_no FROM holders_raw
  ) WHERE policy_id IS NOT NULL AND holder_name IS NOT NULL"""
    q["drop_blank_rows"] = """
  SELECT * FROM (
    SELECT event_id,
           CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_text,
           CASE WHEN event_id % 4 <= 1 THEN NULL ELSE event_type END AS type_text,
           CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END AS props_text
    FROM events
  ) WHERE coalesce(user_text, type_text, props_text) IS NOT NULL"""
    q["pick_by_position"] = """
  SELECT c_mktsegment AS segment, CAST(c_custkey AS VARCHAR) AS holder_id,
         CAST(c_nationkey AS VARCHAR) AS nation, c_name AS holder_name, CAST(NULL AS VARCHAR) AS extra
  FROM customer"""
    pads = [("'  '", "' '"), ("chr(9)", "chr(10)"), ("chr(12288)", "chr(160)"), ("''", "''")]
    arms = " ".join(f"WHEN {i} THEN {a} || p_name || {b}" for i, (a, b) in enumerate(pads))
    q["trim_all"] = f"""
  SELECT p_partkey, name_text,
         regexp_replace(name_text, '^[\\s\\x{{3000}}\\x{{a0}}\\x{{0b}}]+|[\\s\\x{{3000}}\\x{{a0}}\\x{{0b}}]+$', '', 'g') AS name
  FROM (SELECT p_partkey, CASE p_partkey % 4 {arms} END AS name_text FROM part)"""
    q["stack_feeds"] = """
  SELECT CAST(s_suppkey AS VARCHAR) AS party_id, s_name AS party_name, CAST(s_nationkey AS VARCHAR) AS nation,
         'supplier.parquet' AS source_file FROM supplier
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), 'customer.parquet' FROM customer"""
    q["dedup_rows"] = "SELECT DISTINCT * FROM lineitem"
    rest = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ("l_shipdate",) + rest)
    q["dedup_latest"] = f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem
  ) WHERE rn = 1"""
    q["duplicate_keys"] = """
  SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
    batches = """WITH tgt AS (SELECT * FROM orders WHERE year(o_orderdate) <= 1997),
src AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE year(o_orderdate) >= 1996)
"""
    cols = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    pick = ", ".join(f"CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    change = "CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL THEN 'update' WHEN s.o_orderkey IS NOT NULL THEN 'insert' ELSE 'keep' END"
    q["upsert_orders"] = batches + f"SELECT {pick} FROM tgt t FULL OUTER JOIN src s ON t.o_orderkey = s.o_orderkey"
    q["upsert_by_partition"] = batches + f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM (SELECT {pick} FROM tgt t FULL OUTER JOIN src s ON t.o_orderkey = s.o_orderkey)"
    q["upsert_metrics"] = batches + f"""
  SELECT count(*) FILTER (WHERE ch = 'insert') AS inserted, count(*) FILTER (WHERE ch = 'update') AS updated,
         count(*) FILTER (WHERE ch = 'keep') AS kept, count(*) AS total
  FROM (SELECT {change} AS ch FROM tgt t FULL OUTER JOIN src s ON t.o_orderkey = s.o_orderkey)"""
    nbatches = batches.replace("WITH tgt AS", "WITH tgt0 AS").replace("src AS (", "src0 AS (") + """,
tgt AS (SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey) FROM tgt0),
src AS (SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey) FROM src0)
"""
    npick = ", ".join(f"CASE WHEN s.present THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    nchange = "CASE WHEN s.present AND t.present THEN 'update' WHEN s.present THEN 'insert' ELSE 'keep' END AS _change"
    for key, op in (("upsert_null_keys", "="), ("upsert_null_safe", "IS NOT DISTINCT FROM")):
        q[key] = nbatches + f"""
  SELECT {npick}, {nchange}
  FROM (SELECT *, TRUE AS present FROM tgt) t
  FULL OUTER JOIN (SELECT *, TRUE AS present FROM src) s
    ON t.o_orderkey {op} s.o_orderkey AND t.o_custkey {op} s.o_custkey"""
    q["workbook_roundtrip"] = f"""
  SELECT CAST(s_suppkey AS VARCHAR) AS supp_id, s_name AS supp_name, CAST(s_nationkey AS VARCHAR) AS nation,
         CAST(DATE '1995-01-01' + CAST(s_suppkey AS INTEGER) AS VARCHAR) AS since, s_name AS name_inline,
         './inbox/nation_' || s_nationkey || '.xlsx' AS source_file, DATE '{RUN_DATE}' AS load_date
  FROM supplier"""
    q["workbook_blank_rows"] = """
  SELECT CAST(s_suppkey AS VARCHAR) AS supp_id, s_name AS supp_name,
         CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS nation,
         './inbox/nation_' || s_nationkey || '.xlsx' AS source_file
  FROM supplier"""
    q["sheet_rejects"] = """
  SELECT './inbox/region_' || n_regionkey || '.xlsx' AS source_file,
         'nation_' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS sheet,
         CAST(CASE WHEN n_nationkey % 3 = 0 THEN 5 ELSE 12 END AS INTEGER) AS width,
         count(*) AS data_rows, (n_nationkey % 3 <> 0) AS accepted
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  GROUP BY n_regionkey, n_nationkey"""
    q["ingest_report"] = """
  SELECT './inbox/nation_' || s_nationkey || '.xlsx' AS source_file, count(*) AS n_rows
  FROM supplier GROUP BY s_nationkey"""
    q["incremental_ingest"] = """
  SELECT CAST(s_suppkey AS VARCHAR) AS supp_id, s_name AS supp_name, CAST(s_nationkey AS VARCHAR) AS nation,
         './inbox/nation_' || s_nationkey || '.xlsx' AS source_file,
         CASE WHEN s_nationkey < 13 THEN 0 ELSE 1 END AS ingest_epoch
  FROM supplier"""
    q["ingest_same_names"] = """
  SELECT 1 AS run_no, './inbox/nation_' || s_nationkey || '.xlsx' AS source_file, count(*) AS n_rows
  FROM supplier GROUP BY s_nationkey
  UNION ALL
  SELECT 2, './inbox/nation_' || s_nationkey || '.xlsx', count(*) FROM supplier WHERE s_nationkey < 13 GROUP BY s_nationkey"""
    q["ingest_accounting"] = """
WITH r AS (
  SELECT 'region_' || n_regionkey || '.xlsx' AS source_file, n_nationkey, n_nationkey % 3 = 0 AS narrow,
         s_suppkey % 10 = 0 AS blank, s_suppkey % 4 = 0 AS short
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT source_file, count(*) FILTER (WHERE NOT narrow AND NOT blank) AS kept,
       count(*) FILTER (WHERE NOT narrow AND NOT blank AND short) AS kept_short,
       count(*) FILTER (WHERE narrow) AS rejected_narrow, 5 * count(*) FILTER (WHERE narrow) AS rejected_cells,
       (SELECT count(*) FROM r) AS run_seen, (SELECT count(*) FROM r WHERE NOT narrow AND NOT blank) AS run_kept,
       (SELECT count(*) FROM r WHERE NOT narrow AND blank) AS run_blank, (SELECT count(*) FROM r WHERE narrow) AS run_rejected,
       (SELECT count(DISTINCT n_nationkey) FROM r WHERE narrow) AS run_rejected_sheets
FROM r GROUP BY source_file"""
    q["load_once"] = f"""
  SELECT CAST(s_suppkey AS VARCHAR) AS supp_id, s_name AS supp_name, CAST(s_nationkey AS VARCHAR) AS nation,
         DATE '{RUN_DATE}' AS load_date, CASE WHEN s_nationkey < 13 THEN 1 ELSE 2 END AS run_no FROM supplier
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), DATE '{RUN_DATE}',
         CASE WHEN c_nationkey < 13 THEN 3 ELSE 4 END FROM customer"""
    q["pick_columns"] = """
  SELECT c_mktsegment AS segment, CAST(c_custkey AS VARCHAR) AS holder_id,
         CAST(c_nationkey AS VARCHAR) AS nation, c_name AS holder_name FROM customer"""
    q["table_detail"] = """
  SELECT column_name AS col_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
         WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
         ELSE 'string' END AS data_type
  FROM information_schema.columns WHERE table_name = 'orders'"""
    # the run zone is five hours behind UTC all year
    q["run_dates"] = """
  SELECT CAST(ts - INTERVAL 5 HOUR AS DATE) AS run_date, count(*) AS n_events,
         count(*) FILTER (WHERE event_id % 5 <> 0) AS n_read FROM events GROUP BY 1"""
    q["merge_history"] = batches + """
  SELECT 'first_load' AS mode, count(*) AS inserted, CAST(0 AS BIGINT) AS updated, count(*) AS total FROM tgt
  UNION ALL
  SELECT 'merge_partitions', count(*) FILTER (WHERE t.o_orderkey IS NULL),
         count(*) FILTER (WHERE t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL), count(*)
  FROM tgt t FULL OUTER JOIN src s ON t.o_orderkey = s.o_orderkey"""
    lookup = lambda c: f"(SELECT min({c}) FROM lineitem WHERE {c} >= (SELECT avg({c}) FROM lineitem))"
    q["file_skipping"] = "\n  UNION ALL\n".join(
        f"""  SELECT '{c}' AS column_name, {lookup(c)} AS lookup, count(*) AS matching, count(*) AS found_clustered,
         count(*) AS found_plain, TRUE AS clustered_opens_no_more FROM lineitem WHERE {c} = {lookup(c)}"""
        for c in ("l_partkey", "l_suppkey")
    )
    q["compacted"] = "SELECT * FROM lineitem"
    q["compacted_partitions"] = """
  SELECT 'o_year=' || year(o_orderdate) AS partition, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files,
         CAST(CASE WHEN year(o_orderdate) < 1997 THEN 1 ELSE 0 END AS BIGINT) AS files_kept
  FROM orders GROUP BY year(o_orderdate)"""
    q["reclustered_partitions"] = """
  SELECT 'l_year=' || year(l_shipdate) AS partition, count(*) AS n_rows, year(l_shipdate) >= 1997 AS deep_before,
         TRUE AS narrow, year(l_shipdate) < 1997 AS files_stay
  FROM lineitem GROUP BY year(l_shipdate)"""
    q["zordered"] = "SELECT * FROM lineitem"
    q["sketch_stats"] = "\n  UNION ALL\n".join(
        f"""  SELECT '{c}' AS col_name, count(*) AS n_rows, count(*) - count({c}) AS num_nulls,
         {f"CAST(min({c}) AS VARCHAR)" if c != "o_totalprice" else "CAST(NULL AS VARCHAR)"} AS min_value,
         {f"CAST(max({c}) AS VARCHAR)" if c != "o_totalprice" else "CAST(NULL AS VARCHAR)"} AS max_value,
         TRUE AS distinct_near, TRUE AS ranks_near FROM orders"""
        for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    )
    q["table_files"] = """
  SELECT 'o_year=' || year(o_orderdate) AS partition, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows,
         (SELECT count(DISTINCT year(o_orderdate)) FROM orders) AS partitions,
         (SELECT count(DISTINCT year(o_orderdate)) FROM orders) AS files, TRUE AS bytes_add_up, CAST(0 AS BIGINT) AS versions
  FROM orders GROUP BY year(o_orderdate)"""
    q["column_stats"] = """
  SELECT 'o_orderkey' AS col_name, CAST(min(o_orderkey) AS VARCHAR) AS min_value,
         CAST(max(o_orderkey) AS VARCHAR) AS max_value, count(*) - count(o_orderkey) AS num_nulls FROM orders
  UNION ALL
  SELECT 'o_custkey', CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR),
         count(*) - count(o_custkey) FROM orders"""
    sec = "(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts))"
    q["new_rows_gate"] = f"""
WITH ev AS (SELECT *, CAST(floor({sec} / 600) AS BIGINT) AS run_id FROM events),
per_run AS (
  SELECT run_id,
         count(*) FILTER (WHERE event_type IN ('signup', 'purchase')) AS m,
         count(*) FILTER (WHERE event_type IN ('view', 'click')) AS h,
         count(*) FILTER (WHERE event_type = 'error') AS e, count(*) AS n
  FROM ev GROUP BY run_id),
cal AS (SELECT unnest(range(min(run_id), max(run_id) + 1)) AS run_id FROM ev),
led AS (
  SELECT c.run_id,
         CASE WHEN coalesce(e = n, FALSE) THEN -1 ELSE coalesce(m, 0) END AS members_rows,
         CASE WHEN coalesce(e = n, FALSE) THEN -1 ELSE coalesce(h, 0) END AS holders_rows
  FROM cal c LEFT JOIN per_run p ON c.run_id = p.run_id)
SELECT run_id, CAST(members_rows AS BIGINT) AS members_rows, CAST(holders_rows AS BIGINT) AS holders_rows,
       CASE WHEN members_rows = -1 AND holders_rows = -1 THEN 'bypass'
            WHEN members_rows = 0 AND holders_rows = 0 THEN 'skip' ELSE 'run' END AS decision
FROM led"""
    q["replay_date"] = with_(MEMBERS_RAW, members_clean_sql(f"load_date = DATE '{SLICE_DATE}'", SLICE_DATE)) + "SELECT * FROM members_clean"
    q["replay_holders"] = with_(HOLDERS_RAW, holders_clean_sql(f"load_date = DATE '{SLICE_DATE}'", SLICE_DATE)) + "SELECT * FROM holders_clean"
    # All layers: blank-only cells come back trimmed to '', and each clean
    # table keeps the row of a business key that arrived last.
    m_trim = MEMBERS_RAW.replace("'  ' AS surname_1", "'' AS surname_1")
    m_keys = "policy_id, certificate, doc_no, mov_year, mov_month"
    arrival = ("source_file", "sheet_no", "row_no")
    m_rest = arrival + ("policy_start", "policy_end", "cover_start", "cover_end", "doc_type", "doc_last_digit", "member_name")
    h_keys = "policy_id, holder_doc_no, mov_year, mov_month"
    h_rest = arrival + ("doc_type", "holder_name")

    def latest(src, keys, rest):
        order = ", ".join(f"{c} DESC NULLS LAST" for c in rest)
        return f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1)"

    all_layers = f"""
  SELECT DISTINCT m.policy_id, m.policy_start, m.policy_end, m.cover_start, m.cover_end,
         h.holder_doc_no, h.holder_name, m.doc_type, m.doc_no, m.doc_last_digit, m.member_name
  FROM {latest("members_typed WHERE policy_id IS NOT NULL", m_keys, m_rest)} m
  LEFT JOIN {latest("holders_typed WHERE policy_id IS NOT NULL AND holder_name IS NOT NULL", h_keys, h_rest)} h
    ON m.policy_id = h.policy_id"""
    q["upsert_bucketed"] = q["upsert_by_partition"]
    q["gold_bucketed"] = q["gold_consolidated"]
    q["layers_end_to_end"] = with_(m_trim, members_clean_sql(), HOLDERS_RAW, holders_clean_sql()) + all_layers
    q["gold_incremental"] = with_(MEMBERS_RAW, members_clean_sql(), HOLDERS_RAW, holders_clean_sql()) + all_layers
    return q

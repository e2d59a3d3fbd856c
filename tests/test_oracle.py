"""Every registered query against its DuckDB oracle on the smallest data."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from terrace import oracle
from terrace.plans.catalog_queries import QUERIES
from tests.conftest import SMOKE

TABLES = "region nation customer supplier part orders lineitem events".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(oracle.build())
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SMOKE)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(E.oracle_sql()[key])
    d_cols, d_rows = canon(rel.columns, rel.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["policy_id", "policy_start", "policy_end", "cover_start", "cover_end", "holder_doc_no",
                          "holder_name", "doc_type", "doc_no", "doc_last_digit", "member_name"]

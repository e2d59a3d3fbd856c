"""Tables dealt into buckets: their number follows the rows, so that one task's bucket does not grow."""

import uuid

import pytest

from terrace.operators import upsert
from terrace.plans import catalog_queries as Q, medallion, report, runs
from terrace.sources import tables

from .conftest import SMOKE
from .test_layout_runs import drop_config, small_feeds


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(upsert, "ROWS_PER_BUCKET", 500)


def expected(spark):
    n = -(-spark.read.parquet(f"{SMOKE}/lineitem.parquet").count() // 500)
    assert n > 8
    return upsert.Buckets(n, ("policy_id",))


def test_bucket_count_follows_the_rows():
    per = upsert.ROWS_PER_BUCKET
    assert [upsert.bucket_count(n, 8) for n in (0, 8 * per, 8 * per + 1, 100 * per)] == [8, 8, 9, 100]


def test_gold_bucketed_deals_by_rows_and_shuffles_once(spark, small_buckets):
    tables = Q.bucketed_clean(spark, SMOKE)
    assert [upsert.buckets_of(spark, t) for t in tables] == [expected(spark)] * 2
    for name, clean, raw in zip(tables, (medallion.clean_members, medallion.clean_holders), (Q.members_raw, Q.holders_raw)):
        want = clean(raw(spark, SMOKE), Q.RUN_DATE)
        got = spark.table(name).select(*want.columns)
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_gold_incremental_deals_by_rows(spark, small_buckets, monkeypatch):
    seen = []
    monkeypatch.setattr(upsert, "upsert_partitions", lambda *a, _u=upsert.upsert_partitions, **k: seen.append(k["buckets"]) or _u(*a, **k))
    monkeypatch.setattr(report, "refresh_changed", lambda *a, **k: (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):  # after the first load of both feeds
        Q.gold_incremental(spark, SMOKE)
    assert seen == [expected(spark)] * 2


def test_a_run_deals_a_large_first_load_into_more_buckets(spark, scratch, monkeypatch):
    monkeypatch.setattr(upsert, "ROWS_PER_BUCKET", 20)
    m_raw, h_raw = small_feeds(spark)
    cfg = drop_config(scratch, buckets=2, report_parts=2)
    Q.feed_drop(m_raw, medallion.MEMBERS, cfg.members_inbox)
    Q.feed_drop(h_raw, medallion.HOLDERS, cfg.holders_inbox)
    runs.run_all(spark, cfg, "2026-01-15")
    n = upsert.bucket_count(max(m_raw.count(), h_raw.count()), 2)
    assert n > 2 and [upsert.buckets_of(spark, t).n for t in (cfg.members_table, cfg.holders_table)] == [n, n]


@pytest.fixture
def many_shuffle_partitions(spark):
    """More of them than buckets, and kept apart."""
    with tables.setting(spark, "spark.sql.shuffle.partitions", "16"), tables.setting(
        spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"
    ):
        yield


def test_a_merge_leaves_one_file_for_each_bucket_and_partition(spark, scratch, many_shuffle_partitions):
    name, buckets = "bk_" + uuid.uuid4().hex[:8], upsert.Buckets(3, ("k",))
    for first, v in ((0, "a"), (100, "b")):
        rows = spark.createDataFrame([(k, k % 2, v) for k in range(first, first + 200)], "k long, p int, v string")
        upsert.upsert_partitions(rows, name, ["k", "p"], ["p"], on_duplicate="latest", location=f"{scratch}/{name}", buckets=buckets)
    want = [(k, k % 2, "b" if k >= 100 else "a") for k in range(300)]
    assert sorted(map(tuple, spark.table(name).select("k", "p", "v").collect())) == want
    assert tables.files(spark, name).groupBy("partition").count().select("count").distinct().collect() == [(3,)]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "16"


def test_the_report_joins_bucketed_tables_where_they_lie(spark, scratch, many_shuffle_partitions, monkeypatch):
    """Neither that join nor the sort of the report's rows depends on the session's number of shuffle partitions."""
    tag, plans, sorts, names = uuid.uuid4().hex[:8], [], [], []
    m_raw, h_raw = small_feeds(spark)
    for feed, rows in ((medallion.MEMBERS, medallion.clean_members(m_raw, Q.RUN_DATE)), (medallion.HOLDERS, medallion.clean_holders(h_raw, Q.RUN_DATE))):
        names.append(f"{feed.name}_{tag}")
        upsert.upsert_partitions(
            rows.dropDuplicates(feed.keys), names[-1], feed.keys, runs.PERIOD, location=f"{scratch}/{names[-1]}",
            buckets=upsert.Buckets(3, ("policy_id",)),
        )

    def consolidate(members, holders, _c=medallion.consolidate):
        joined = _c(members, holders)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    def by_range(df, *by, _r=type(m_raw).repartitionByRange):
        sorts.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return _r(df, *by)

    with monkeypatch.context() as patched, tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        patched.setattr(medallion, "consolidate", consolidate)
        patched.setattr(type(m_raw), "repartitionByRange", by_range)
        patched.setattr(report, "PACKED_BYTES_PER_PARTITION", 100, raising=False)
        for load in range(2):
            report.note_changes(spark.table(names[0]).where("policy_id % 2 = 0"), scratch + "/changes", f"load-{load}")
            report.refresh_changed(spark, *names, f"g_{tag}", scratch + "/changes", 4, f"{scratch}/g")
    first, second = plans
    assert "Exchange" not in first
    assert ", 16)" not in second and second.count("Bucketed: true") == 2  # the changed policies alone are dealt, to the buckets
    assert len(sorts) == 2 and min(sorts) > 16
    full = medallion.consolidate(*map(spark.table, names))
    got = spark.table(f"g_{tag}").select(*medallion.GOLD_COLUMNS)
    assert got.count() == full.count() > 0 and got.exceptAll(full).isEmpty()

"""Merges of bucketed tables, and the report kept up to date by changed policies."""

import uuid

import pytest
from pyspark.sql import functions as F

from terrace.operators import upsert
from terrace.plans import catalog_queries as Q
from terrace.plans import medallion, report, runs
from tests.conftest import SMOKE
from tests.test_layout_runs import drop_config, small_feeds

DAY = "2026-01-15"
BUCKETS = upsert.Buckets(6, ("k",))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


def load(spark, name, rows, scratch, buckets=BUCKETS):
    df = spark.createDataFrame(rows, "k long, p int, v string")
    return upsert.upsert_partitions(df, name, ["k", "p"], ["p"], location=f"{scratch}/{name}", buckets=buckets)


def test_bucketed_merge_leaves_the_target_where_it_lies(spark, scratch):
    name = "bk_" + uuid.uuid4().hex[:8]
    load(spark, name, [(k, k % 3, "a") for k in range(200)], scratch)
    assert upsert.buckets_of(spark, name) == BUCKETS
    old = spark.table(name)
    source = spark.createDataFrame([(k, k % 3, "b") for k in range(150, 250)], "k long, p int, v string").repartition(3)
    src = upsert.split_source(source, ["k", "p"])
    with upsert.co_located(spark):
        merged = plan(upsert.merge_changes(old, src, ["k", "p"]))
    target_side, source_side = merged.split("Sort [s__", 1)
    assert "Exchange" not in target_side and "Exchange hashpartitioning(s__k" in source_side
    assert "Bucketed: true" in target_side
    assert "Exchange hashpartitioning(t__k" in plan(upsert.merge_changes(old, src, ["k", "p"]))
    res = load(spark, name, [(k, k % 3, "b") for k in range(150, 250)], scratch, buckets=None)
    assert (res.inserted, res.updated, res.total) == (50, 50, 250)
    assert upsert.buckets_of(spark, name) == BUCKETS  # whatever the caller passes
    want = [(k, k % 3, "b" if k >= 150 else "a") for k in range(250)]
    assert sorted(map(tuple, spark.table(name).select("k", "p", "v").collect())) == want
    # every file still holds the one bucket that it is named for
    placed = spark.table(name).select(
        F.regexp_extract(F.input_file_name(), r"_(\d+)\.c\d+", 1).cast("int").alias("named"), F.pmod(F.hash("k"), F.lit(6)).alias("held")
    )
    assert placed.where("named <> held").count() == 0 and placed.select("named").distinct().count() == 6


def test_bucket_columns_are_part_of_the_key(spark, scratch):
    with pytest.raises(ValueError, match="bucket columns"):
        load(spark, "bk_" + uuid.uuid4().hex[:8], [(1, 1, "a")], scratch, upsert.Buckets(4, ("v",)))


def test_null_keys_in_a_bucketed_table(spark, scratch):
    name = "bk_" + uuid.uuid4().hex[:8]
    load(spark, name, [(None, 1, "a"), (1, 1, "a")], scratch)
    load(spark, name, [(None, 1, "b"), (1, 1, "b"), (2, None, "b")], scratch)
    got = sorted(((r.k, r.p, r.v) for r in spark.table(name).collect()), key=str)
    assert got == sorted([(None, 1, "a"), (None, 1, "b"), (1, 1, "b"), (2, None, "b")], key=str)


def test_report_join_of_two_bucketed_tables_shuffles_nothing(spark):
    members, holders = Q.bucketed_clean(spark, SMOKE)
    text = plan(medallion.consolidate(spark.table(members), spark.table(holders)))
    assert "Exchange" not in text or "BroadcastExchange" in text
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(medallion.consolidate(spark.table(members), spark.table(holders)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_report_follows_three_runs_and_reads_changed_policies_only(spark, scratch):
    tag = uuid.uuid4().hex[:8]
    members, holders, gold, changes = f"rm_{tag}", f"rh_{tag}", f"rg_{tag}", scratch + "/changes"
    m = medallion.clean_members(Q.members_raw(spark, SMOKE), DAY).dropDuplicates(medallion.MEMBERS.keys)
    h = medallion.clean_holders(Q.holders_raw(spark, SMOKE), DAY).dropDuplicates(medallion.HOLDERS.keys)
    m.write.parquet(scratch + "/m")
    h.write.parquet(scratch + "/h")
    m, h = spark.read.parquet(scratch + "/m"), spark.read.parquet(scratch + "/h")
    loads = (
        (m.where("policy_id % 10 < 8"), h.where("policy_id % 10 < 5")),
        (m.where("policy_id % 10 = 8"), h.where("policy_id % 10 = 5").withColumn("holder_name", F.lit("new"))),
        (m.where("policy_id % 10 = 3").withColumn("member_name", F.lit("changed")), h.where("policy_id % 10 > 5")),
    )
    for no, (m_rows, h_rows) in enumerate(loads):
        for name, rows, feed in ((members, m_rows, medallion.MEMBERS), (holders, h_rows, medallion.HOLDERS)):
            upsert.upsert_partitions(rows, name, feed.keys, runs.PERIOD, location=f"{scratch}/{name}")
            report.note_changes(rows, changes, f"{feed.name}-{no}")
        res = report.refresh_changed(spark, members, holders, gold, changes, parts=8, location=f"{scratch}/{gold}")
        full = medallion.consolidate(spark.table(members), spark.table(holders))
        assert rows_of(spark.table(gold).select(*medallion.GOLD_COLUMNS)) == rows_of(full)
        assert res.first == (no == 0)
        if no:
            changed = m_rows.select("policy_id").union(h_rows.select("policy_id")).distinct()
            assert res.policies == changed.count() > 0
            assert res.joined_rows == full.join(changed, "policy_id", "left_semi").count()
            assert res.joined_rows + res.kept_rows <= full.count() and res.kept_rows > 0
    again = report.refresh_changed(spark, members, holders, gold, changes)
    assert (again.policies, again.parts, again.joined_rows) == (0, 0, 0)
    # noted, then applied a second time: no harm
    report.note_changes(loads[0][0], changes, "again")
    report.refresh_changed(spark, members, holders, gold, changes)
    assert rows_of(spark.table(gold).select(*medallion.GOLD_COLUMNS)) == rows_of(full)


def test_whole_run_with_buckets_and_report_by_changes(spark, scratch):
    m_raw, h_raw = small_feeds(spark)
    cfg = drop_config(scratch, buckets=4, report_parts=4)
    Q.feed_drop(m_raw.where("sheet_no % 2 = 0"), medallion.MEMBERS, cfg.members_inbox)
    Q.feed_drop(h_raw, medallion.HOLDERS, cfg.holders_inbox)
    runs.run_all(spark, cfg, DAY)
    Q.feed_drop(m_raw.where("sheet_no % 2 = 1"), medallion.MEMBERS, cfg.members_inbox)
    Q.feed_drop(h_raw.limit(0), medallion.HOLDERS, cfg.holders_inbox)
    out = runs.run_all(spark, cfg, "2026-01-16")
    assert out.gold_version == cfg.gold_table
    full = medallion.consolidate(spark.table(cfg.members_table), spark.table(cfg.holders_table))
    assert rows_of(spark.table(cfg.gold_table).select(*medallion.GOLD_COLUMNS)) == rows_of(full)


def test_a_repeated_key_fails_whatever_it_holds(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    twice = spark.createDataFrame([(2, "x"), (2, "x"), (None, "n"), (None, "n")], target.schema)
    with pytest.raises(Exception, match="repeats key"):
        upsert.upsert(target, twice, ["k"]).collect()
    nulls = twice.where("k is null")
    assert upsert.upsert(target, nulls, ["k"]).count() == 3
    with pytest.raises(Exception, match="repeats key"):
        upsert.upsert(target, nulls, ["k"], null_safe=True).collect()


def test_reject_counts_come_from_the_one_projection(spark):
    """Counted on the parsed columns: the same figures, and no date is parsed a second time."""
    from pyspark.sql import Observation

    for feed, raw, clean, counts in (
        ("members", Q.members_raw(spark, SMOKE), medallion.clean_members, medallion.member_rejects),
        ("holders", Q.holders_raw(spark, SMOKE), medallion.clean_holders, medallion.holder_rejects),
    ):
        seen = Observation(feed + uuid.uuid4().hex)
        watched = clean(raw, DAY, distinct=False, watch=seen)
        parses = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("gettimestamp")
        assert parses(watched) == parses(clean(raw, DAY, distinct=False))
        watched.write.format("noop").mode("overwrite").save()
        assert dict(seen.get) == counts(raw).first().asDict()

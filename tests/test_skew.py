"""Hot keys: one policy holding a third of all rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrace.operators import frames, upsert
from terrace.plans import medallion

HOT = -7  # no ordinary id collides with it


def members(spark, n=3000):
    ids = spark.range(n)
    pol = F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id")).cast("long")
    return ids.select(
        pol.alias("policy_id"),
        F.lit(dt.date(2024, 1, 1)).alias("policy_start"),
        F.lit(dt.date(2024, 12, 31)).alias("policy_end"),
        F.col("id").cast("string").alias("certificate"),
        F.lit(dt.date(2024, 1, 1)).alias("cover_start"),
        F.lit(dt.date(2024, 2, 1)).alias("cover_end"),
        F.lit("DNI").alias("doc_type"),
        F.lpad(F.col("id").cast("string"), 8, "0").alias("doc_no"),
        (F.col("id") % 10).cast("int").alias("doc_last_digit"),
        F.concat(F.lit("M"), F.col("id").cast("string")).alias("member_name"),
        F.lit(2024).alias("mov_year"),
        F.lit(1).alias("mov_month"),
        F.lit(dt.date(2026, 1, 15)).alias("load_date"),
    )


def holders(spark):
    rows = [(HOT, "DNI", f"H{i}", f"holder {i}", 2024, 1) for i in range(3)] + [(1, "RUC", "R1", "one", 2024, 1)]
    return spark.createDataFrame(
        rows, "policy_id long, doc_type string, holder_doc_no string, holder_name string, mov_year int, mov_month int"
    ).withColumn("load_date", F.lit(dt.date(2026, 1, 15)))


@pytest.fixture
def skew_conf(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_policy_join_is_split_and_exact(spark, skew_conf):
    m, h = members(spark), holders(spark)
    gold = medallion.consolidate(m, h)
    got = gold.collect()
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    # 1000 hot members × 3 holders, 1 member of policy 1 × 1 holder, the rest unmatched.
    assert len(got) == 1000 * 3 + 1 + (2000 - 1)
    hot = [r for r in got if r.policy_id == HOT]
    assert len(hot) == 3000 and len({(r.doc_no, r.holder_doc_no) for r in hot}) == 3000


def test_hot_key_dedup_reduces_map_side(spark):
    # A third of the rows share one key: max_by combines them before the shuffle.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    out = frames.dedup_latest(df, ["k"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("ObjectHashAggregate") + plan.count("SortAggregate") >= 2
    assert out.filter("k = -1").first().v == 2997


def test_null_keys_do_not_meet_in_one_partition(spark, skew_conf):
    # A third of the rows have a NULL key part: they bypass the join.
    t = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), F.lit("t").alias("v")
    )
    s = spark.range(300, 330).select(F.lit(None).cast("long").alias("k"), F.lit("s").alias("v"))
    merged = upsert.merge_changes(t, s, ["k"])
    counts = {r["_change"]: r["count"] for r in merged.groupBy("_change").count().collect()}
    assert counts == {"keep": 300, "insert": 30}
    # All of them together would be one partition's work; their hash spreads them over the join's partitions.
    where = merged.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(where) >= 4 and max(r["count"] for r in where) < 150


def test_null_keys_need_no_second_scan(spark, scratch):
    spark.range(30).select(F.col("id").alias("k"), F.lit("t").alias("v")).write.parquet(scratch + "/t")
    spark.range(20).select(F.col("id").alias("k"), F.lit("s").alias("v")).write.parquet(scratch + "/s")
    merged = upsert.merge_changes(spark.read.parquet(scratch + "/t"), spark.read.parquet(scratch + "/s"), ["k"])
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


@pytest.mark.parametrize("by_period", [False, True])
def test_salted_join_equals_plain(spark, by_period):
    m, h = members(spark), holders(spark)
    plain = sorted((tuple(r) for r in medallion.consolidate(m, h, by_period).collect()), key=str)
    salted_df = medallion.consolidate(m, h, by_period, salt=8)
    salted = sorted((tuple(r) for r in salted_df.collect()), key=str)
    assert salted == plain
    assert "_salt" in salted_df._jdf.queryExecution().optimizedPlan().toString()


def test_join_output_is_not_shuffled_again(spark):
    m, h = members(spark), holders(spark)
    plan = medallion.consolidate(m, h)._jdf.queryExecution().executedPlan().toString()
    # AQE's initial plan lists operators top-down: everything above the join
    # must be projection only (the pre-join distincts make the output distinct).
    body = plan.split("Initial Plan ==")[-1] if "Initial Plan" in plan else plan
    above_join = body.split("Join")[0]
    assert "Exchange" not in above_join and "Aggregate" not in above_join

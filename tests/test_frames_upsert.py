"""Frame operators and the upsert."""

import pytest
from pyspark.sql import functions as F

from terrace.operators import frames, upsert


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


def test_pick_by_position_and_guard(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "x int, y string, z double")
    out = frames.pick_by_position(df, [2, 0], ["zz", "xx"])
    assert out.columns == ["zz", "xx"] and out.first() == (2.0, 1)
    with pytest.raises(ValueError):
        frames.pick_by_position(df, [3], ["w"])


def test_cells_past_the_end_are_null(spark):
    df = spark.createDataFrame([(["a", "b"],)], "cells array<string>")
    assert df.select(*frames.cells_by_position("cells", [1, 5], ["b", "f"])).first() == ("b", None)


def test_dedup_latest_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "a"), (1, "2024-02-01", "b"), (1, "2024-02-01", "c"), (2, None, "z"), (2, "2023-01-01", "y")],
        "k int, d string, v string",
    )
    assert rows(frames.dedup_latest(df, ["k"], ["d"])) == sorted([(1, "2024-02-01", "c"), (2, "2023-01-01", "y")], key=str)
    # Same answer whatever the input order / partitioning.
    assert rows(frames.dedup_latest(df.repartition(3).orderBy(F.rand(7)), ["k"], ["d"])) == rows(
        frames.dedup_latest(df, ["k"], ["d"])
    )


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    assert rows(frames.duplicate_keys(df, ["a", "b"])) == sorted([(None, 3, 2), (1, 1, 2)], key=str)


def test_stack_by_position(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2, "y")], "j int, t string")
    assert rows(frames.stack([a, b])) == sorted([(1, "x"), (2, "y")], key=str)
    with pytest.raises(ValueError):
        frames.stack([a, spark.createDataFrame([(1,)], "i int")])


def test_drop_blank_rows_and_require(spark):
    df = spark.createDataFrame([(None, None), ("a", None), (None, "b")], "x string, y string")
    assert rows(frames.drop_blank_rows(df)) == sorted([(None, "b"), ("a", None)], key=str)
    assert rows(frames.require(df, "x")) == [("a", None)]


def test_lineage(spark):
    df = spark.createDataFrame([("file:/vol/inbox/Members/f1.xlsx",)], "path string")
    assert df.select(frames.lineage("path"), frames.file_name("path")).first() == ("./Members/f1.xlsx", "f1.xlsx")


TGT = [(1, "a"), (2, "b"), (None, "n")]
SRC = [(2, "B"), (3, "c"), (None, "N")]


def test_upsert_fixture(spark):
    t = spark.createDataFrame(TGT, "k int, v string")
    s = spark.createDataFrame(SRC, "k int, v string")
    assert rows(upsert.upsert(t, s, ["k"])) == sorted([(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "N")], key=str)
    counts = upsert.change_counts(upsert.merge_changes(t, s, ["k"])).first().asDict()
    assert counts == {"inserted": 2, "updated": 1, "kept": 2, "total": 5}


def test_upsert_null_safe(spark):
    t = spark.createDataFrame(TGT, "k int, v string")
    s = spark.createDataFrame(SRC, "k int, v string")
    assert rows(upsert.upsert(t, s, ["k"], null_safe=True)) == sorted([(1, "a"), (2, "B"), (3, "c"), (None, "N")], key=str)


def test_upsert_twice_is_once(spark):
    t = spark.createDataFrame(TGT, "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert.upsert(t, s, ["k"])
    assert rows(upsert.upsert(once, s, ["k"])) == rows(once)


def test_duplicate_source_keys(spark):
    s = spark.createDataFrame([(1, "x", "2024-01-01"), (1, "y", "2024-02-01"), (None, "n", "x"), (None, "m", "x")],
                              "k int, v string, d string")
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.prepare_source(s, ["k"])
    latest = upsert.prepare_source(s, ["k"], "latest", ["d"])
    assert rows(latest) == sorted([(1, "y", "2024-02-01"), (None, "n", "x"), (None, "m", "x")], key=str)


def test_upsert_table_first_load_then_merge(spark):
    name = "upsert_t_" + __import__("uuid").uuid4().hex[:8]
    first = upsert.upsert_table(spark.createDataFrame(TGT, "k int, v string"), name, ["k"])
    assert (first.mode, first.inserted, first.total) == ("first_load", 3, 3)
    res = upsert.upsert_table(spark.createDataFrame(SRC, "k int, v string"), name, ["k"])
    assert (res.mode, res.inserted, res.updated, res.total) == ("merge", 2, 1, 5)
    assert rows(spark.table(name)) == sorted([(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "N")], key=str)


def test_repeated_source_keys_fail_a_plain_merge(spark):
    t = spark.createDataFrame(TGT, "k int, v string")
    s = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(Exception, match="source repeats key"):
        upsert.upsert(t, s, ["k"]).collect()
    # keys with a NULL part never match, so they may repeat, exactly or not
    s = spark.createDataFrame([(None, "x"), (None, "x"), (None, "y")], "k int, v string")
    assert rows(upsert.upsert(t, s, ["k"])) == sorted([*TGT, (None, "x"), (None, "x"), (None, "y")], key=str)


def test_first_load_into_existing_empty_table(spark, scratch):
    tag = __import__("uuid").uuid4().hex[:8]
    t = spark.createDataFrame([(1, 2020, "a")], "k int, y int, v string")
    spark.sql(f"CREATE TABLE empty_p_{tag} (k int, v string, y int) USING parquet PARTITIONED BY (y) LOCATION '{scratch}/e'")
    assert upsert.upsert_partitions(t, f"empty_p_{tag}", ["k", "y"], ["y"]).mode == "first_load"
    assert [tuple(r) for r in spark.table(f"empty_p_{tag}").select("k", "y", "v").collect()] == [(1, 2020, "a")]
    spark.sql(f"CREATE TABLE empty_t_{tag} (k int, y int, v string) USING parquet")
    assert upsert.upsert_table(t, f"empty_t_{tag}", ["k"]).mode == "first_load"
    assert spark.table(f"empty_t_{tag}").count() == 1


def test_only_the_exact_period_pairs_are_rewritten(spark, scratch):
    import os

    name = "pairs_" + __import__("uuid").uuid4().hex[:8]
    periods = [(y, m) for y in (2023, 2024) for m in (1, 12)] + [(None, 1)]
    t = spark.createDataFrame([(i, y, m, "t") for i, (y, m) in enumerate(periods)], "k int, y int, m int, v string")
    upsert.upsert_partitions(t, name, ["k", "y", "m"], ["y", "m"], location=scratch + "/p")
    root = scratch.replace("file:", "") + "/p"
    listing = lambda: {d: sorted(f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")) for d in ("y=2023/m=1", "y=2023/m=12", "y=2024/m=1", "y=2024/m=12")}
    before = listing()
    s = spark.createDataFrame([(1, 2023, 12, "s"), (2, 2024, 1, "s"), (9, None, 1, "s")], "k int, y int, m int, v string")
    res = upsert.upsert_partitions(s, name, ["k", "y", "m"], ["y", "m"], history=scratch + "/h")
    after = listing()
    assert (res.inserted, res.updated, res.total) == (1, 2, 6)  # the NULL period never matches
    assert [d for d in before if before[d] != after[d]] == ["y=2023/m=12", "y=2024/m=1"]
    assert spark.read.parquet(scratch + "/h").first().updated == 2


def test_many_touched_partitions_keep_the_others(spark):
    name = "many_" + __import__("uuid").uuid4().hex[:8]
    t = spark.range(60).select(F.col("id").alias("k"), (F.col("id") % 30).cast("int").alias("p"), F.lit("t").alias("v"))
    upsert.upsert_partitions(t, name, ["k", "p"], ["p"])
    res = upsert.upsert_partitions(t.filter("p < 25").withColumn("v", F.lit("s")), name, ["k", "p"], ["p"])
    assert (res.inserted, res.updated, res.total) == (0, 50, 60)


def test_source_with_other_columns_is_refused(spark):
    t = spark.createDataFrame(TGT, "k int, v string")
    with pytest.raises(ValueError):
        upsert.merge_changes(t, spark.createDataFrame([(1, "a", 1)], "k int, v string, extra int"), ["k"])


def test_upsert_partitions_rewrites_only_touched(spark):
    import os

    name = "part_up_" + __import__("uuid").uuid4().hex[:8]
    t = spark.createDataFrame([(1, 2020, "a"), (2, 2021, "b"), (3, None, "n")], "k int, y int, v string")
    first = upsert.upsert_partitions(t, name, ["k", "y"], ["y"])
    assert first.mode == "first_load"
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first().data_type
    p2020 = loc.replace("file:", "") + "/y=2020"
    before = sorted(os.listdir(p2020))
    s = spark.createDataFrame([(2, 2021, "B"), (4, 2021, "d"), (5, None, "N")], "k int, y int, v string")
    res = upsert.upsert_partitions(s, name, ["k", "y"], ["y"])
    assert (res.inserted, res.updated) == (2, 1)
    spark.catalog.refreshTable(name)
    got = sorted((tuple(r) for r in spark.table(name).select("k", "y", "v").collect()), key=str)
    assert got == sorted([(1, 2020, "a"), (2, 2021, "B"), (4, 2021, "d"), (3, None, "n"), (5, None, "N")], key=str)
    assert sorted(os.listdir(p2020)) == before  # untouched partition not rewritten
    again = upsert.upsert_partitions(s, name, ["k", "y"], ["y"])
    spark.catalog.refreshTable(name)
    assert again.inserted == 0 + 1  # the NULL-partition key never matches: inserted again


def test_append_refuses_other_schema(spark):
    from terrace.sources import tables

    name = "app_" + __import__("uuid").uuid4().hex[:8]
    tables.append(spark.createDataFrame([("a", 1)], "s string, n int"), name)
    tables.append(spark.createDataFrame([(2, "b")], "n int, s string"), name)  # same columns, other order
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        tables.append(spark.createDataFrame([("c", 3, 0)], "s string, n int, extra int"), name)


def test_latest_source_feeds_merge_join_without_reshuffle(spark):
    # The keyed part comes out of the per-key aggregate hash-partitioned by
    # the key; the merge join must not shuffle it again.
    t = spark.range(50).select(F.col("id").alias("k"), F.lit("t").alias("v"))
    s = spark.range(40, 60).union(spark.range(40, 45)).select(F.col("id").alias("k"), F.lit("s").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = upsert.split_source(s, ["k"], "latest", ["v"])
        merged = upsert.merge_changes(t, src, ["k"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(t__k" in plan  # the target side is shuffled
        assert "hashpartitioning(s__k" not in plan  # the source side is not, again
        counts = {r["_change"]: r["count"] for r in merged.groupBy("_change").count().collect()}
        assert counts == {"keep": 40, "update": 10, "insert": 10}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_table_clustered_with_history(spark, scratch):
    name = "clu_" + __import__("uuid").uuid4().hex[:8]
    t = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"), F.lit("t").alias("v"))
    s = spark.range(150, 260).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"), F.lit("s").alias("v"))
    upsert.upsert_table(t, name, ["k", "g"], cluster_files=3, history=scratch + "/hist")
    res = upsert.upsert_table(s, name, ["k", "g"], cluster_files=3, history=scratch + "/hist")
    assert (res.inserted, res.updated, res.total) == (60, 50, 260)
    assert spark.table(name).count() == 260 and spark.table(name).filter("v = 's'").count() == 110
    hist = sorted((r.mode, r.inserted, r.updated) for r in spark.read.parquet(scratch + "/hist").collect())
    assert hist == [("first_load", 200, 0), ("merge", 60, 50)]


def test_as_text(spark):
    df = spark.createDataFrame([(1, 2.5, "x")], "i int, d double, s string")
    out = frames.as_text(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string"] * 3
    assert out.first() == ("1", "2.5", "x")


def test_upsert_partitions_writes_few_files_per_partition(spark):
    import os

    name = "part_files_" + __import__("uuid").uuid4().hex[:8]
    t = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"), F.lit("t").alias("v"))
    upsert.upsert_partitions(t.repartition(8), name, ["k", "y"], ["y"])
    s = spark.range(1500, 2500).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"), F.lit("s").alias("v"))
    upsert.upsert_partitions(s.repartition(8), name, ["k", "y"], ["y"])
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 2500
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first().data_type
    root = loc.replace("file:", "")
    for part in (d for d in os.listdir(root) if d.startswith("y=")):
        files = [f for f in os.listdir(f"{root}/{part}") if f.endswith(".parquet")]
        assert len(files) <= 2, (part, len(files))

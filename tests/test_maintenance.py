"""Upkeep by partition: what is rewritten, what stays, and that no row changes."""

import uuid

import pytest
from pyspark.sql import functions as F

from terrace.operators import layout, maintenance
from terrace.sources import tables


def multiset(df):
    return sorted(map(str, df.collect()))


def names(spark, name):
    return {(r.partition, r.file) for r in tables.files(spark, name).collect()}


@pytest.fixture
def grown(spark, scratch):
    """Partitions p: 'one' a file; 'a/b+c %=é' and NULL grown by six appends."""
    name = "upkeep_" + uuid.uuid4().hex[:8]
    rows = spark.range(3000).select(
        "id", (F.col("id") % 500).alias("v"), F.when(F.col("id") % 3 == 0, "one").when(F.col("id") % 3 == 1, "a/b+c %=é").alias("p")
    )
    tables.overwrite(rows.where("p = 'one'").coalesce(1), name, ["p"], location=scratch + "/t")
    for k in range(6):
        tables.append(rows.where(f"(p is null or p <> 'one') and floor(id / 3) % 6 = {k}").coalesce(1), name)
    return name, multiset(rows)


def test_only_partitions_with_small_files_are_packed(spark, grown):
    name, rows = grown
    before = names(spark, name)
    assert len(before) == 13
    assert maintenance.compact_partitions(spark, name, least_small=7) == []
    done = maintenance.compact_partitions(spark, name)
    assert sorted(done, key=str) == [(None,), ("a/b+c %=é",)] or sorted(done, key=str) == [("a/b+c %=é",), (None,)]
    after = names(spark, name)
    assert len(after) == 3 and {f for f in after & before if f[0] == "p=one"} and len(after & before) == 1
    assert multiset(spark.table(name)) == rows
    assert maintenance.compact_partitions(spark, name) == [] and names(spark, name) == after


def test_packed_files_hold_about_the_bytes_asked_for(spark, grown):
    name, rows = grown
    sizes = [r.bytes for r in tables.files(spark, name).collect() if r.partition != "p=one"]
    maintenance.compact_partitions(spark, name, file_bytes=2 * max(sizes) + 2)
    assert len(names(spark, name)) == 1 + 2 * 3  # a bin takes the file that passes its size: two or three of six a bin
    assert multiset(spark.table(name)) == rows


def brute_depth(ranges):
    wide = [r for r in ranges if r[0] < r[1]]
    return max([1, *(sum(lo <= v <= hi for lo, hi in wide) for r in wide for v in r)])


def test_overlap_and_clustering(spark, grown):
    name, rows = grown
    found = {r.p: (r.files, r.depth) for r in maintenance.overlap(spark, name, ["v", "id"]).collect()}
    ranges = {}
    own = spark.table(name).groupBy("p", F.col("_metadata.file_name").alias("f"))
    for r in own.agg(*[g(c).alias(f"{c}_{k}") for c in ("v", "id") for k, g in (("lo", F.min), ("hi", F.max))]).collect():
        ranges.setdefault(r.p, []).append(((r.v_lo, r.v_hi), (r.id_lo, r.id_hi)))
    assert found == {p: (len(x), max(brute_depth([y[i] for y in x]) for i in (0, 1))) for p, x in ranges.items()}
    before = names(spark, name)
    size = sum(r.bytes for r in tables.files(spark, name).collect())
    done = maintenance.recluster_partitions(spark, name, ["v"], file_bytes=size // 12)
    assert {d[0] for d in done} == {None, "a/b+c %=é"}
    after = names(spark, name)
    assert {f for f in before if f[0] == "p=one"} <= after and len(after) > 6
    assert all(r.depth <= 2 for r in maintenance.overlap(spark, name, ["v"]).collect())
    assert multiset(spark.table(name)) == rows
    assert maintenance.recluster_partitions(spark, name, ["v"]) == [] and names(spark, name) == after


def test_tables_that_are_refused_and_empty_ones(spark, scratch):
    plain, bucketed, empty = ("upkeep_" + uuid.uuid4().hex[:8] for _ in range(3))
    tables.overwrite(spark.range(5), plain, location=scratch + "/plain")
    rows = spark.range(9).withColumn("p", F.col("id") % 2)
    rows.write.partitionBy("p").bucketBy(2, "id").option("path", scratch + "/bucketed").saveAsTable(bucketed)
    for name in (plain, bucketed):
        with pytest.raises(ValueError):
            maintenance.compact_partitions(spark, name)
        with pytest.raises(ValueError):
            maintenance.recluster_partitions(spark, name, ["id"])
    tables.overwrite(rows.limit(0), empty, ["p"], location=scratch + "/empty")
    assert maintenance.compact_partitions(spark, empty) == [] == maintenance.recluster_partitions(spark, empty, ["id"])
    assert layout.DEFAULT_FILE_BYTES == 128 << 20

"""Statistics that add up, heavy hitters of the report's join, and table detail from files."""

import datetime as dt
import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from terrace.operators import statistics
from terrace.plans import medallion
from terrace.sources import tables

SCHEMA = "n long, d date, x double, t string"


def rows(rng, count, low=0):
    return [
        (
            None if rng.random() < 0.1 else low + rng.randrange(500),
            dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(300)),
            rng.choice([None, math.nan, rng.gauss(0, 9), rng.gauss(0, 9)]),
            rng.choice([None, "", "é", f"v{rng.randrange(90)}"]),
        )
        for _ in range(count)
    ]


def read(df):
    return {r.col_name: r for r in df.collect()}


def test_merged_loads_say_what_one_pass_says(spark, scratch):
    rng, whole = random.Random(1), []
    for load in range(4):
        part = rows(rng, 400 * load, low=load * 100)  # the first is empty
        whole += part
        statistics.record(spark.createDataFrame(part, SCHEMA), list("ndxt"), scratch + "/s", f"2026-01-0{load + 1}")
    again = rows(random.Random(2), 50)
    statistics.record(spark.createDataFrame(again, SCHEMA), list("ndxt"), scratch + "/s", "2026-01-01")  # in place of the empty one
    whole += again
    stored = statistics.recorded(spark, scratch + "/s")
    assert stored.count() == 16
    got = read(statistics.summary(statistics.merge(stored)))
    df = spark.createDataFrame(whole, SCHEMA)
    for i, c in enumerate("ndxt"):
        values = [r[i] for r in whole if r[i] is not None]
        assert (got[c].n_rows, got[c].num_nulls) == (len(whole), len(whole) - len(values))
        exact = df.agg(F.count_distinct(c)).first()[0]
        assert abs(got[c].distinct_estimate - exact) <= max(1, 0.05 * exact)
    numbers = sorted(r[0] for r in whole if r[0] is not None)
    assert (got["n"].min_value, got["n"].max_value) == (str(numbers[0]), str(numbers[-1]))
    for q, v in zip((0.25, 0.5, 0.75), got["n"].quantiles):
        assert abs(sum(x <= v for x in numbers) / len(numbers) - q) < 0.05
    days = [(r[1] - dt.date(1970, 1, 1)).days for r in whole]
    assert (got["d"].min_value, got["d"].max_value) == (str(min(days)), str(max(days)))
    assert got["x"].max_value == "NaN" and got["x"].quantiles[0] < got["x"].quantiles[2]
    assert got["t"].min_value == "" and got["t"].quantiles is None


def test_statistics_by_group_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 7), ("c", None)], "g string, n long")
    got = {r.g: r for r in statistics.summary(statistics.collect(df, ["n"], ["g"])).collect()}
    assert (got["a"].n_rows, got["a"].num_nulls, got["a"].quantiles) == (2, 1, [1.0, 1.0, 1.0])
    assert (got["c"].min_value, got["c"].distinct_estimate, got["c"].quantiles) == (None, 0, None)
    empty = statistics.summary(statistics.collect(df.limit(0), ["n"])).first()
    assert (empty.n_rows, empty.min_value, empty.distinct_estimate) == (0, None, 0)


def feeds(spark, hot_share):
    """5,000 members of which one policy has a large part, and holders of every policy."""
    m = spark.range(5000).select(
        F.when(F.col("id") < int(5000 * hot_share), 7).otherwise(F.col("id") % 400 + 100).cast("long").alias("policy_id"),
        *[F.lit(dt.date(2024, 1, 1)).alias(c) for c in medallion.MEMBER_DATE_COLUMNS],
        F.lit("DNI").alias("doc_type"), F.col("id").cast("string").alias("doc_no"), F.lit(1).alias("doc_last_digit"),
        F.lit("A").alias("member_name"), F.lit(2024).alias("mov_year"), F.lit(1).alias("mov_month"),
    )
    h = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("policy_id"),
        F.concat(F.lit("h"), F.col("id")).alias("holder_doc_no"), F.lit("H").alias("holder_name"),
        F.lit(2024).alias("mov_year"), F.lit(1).alias("mov_month"),
    )
    return m, h


@pytest.mark.parametrize("hot_share", [0.0, 0.4])
def test_heavy_hitters_are_split_and_the_rest_left_alone(spark, hot_share):
    m, h = feeds(spark, hot_share)
    hot = medallion.hot_policies(m, support=0.05)
    assert (7 in hot) == (hot_share > 0) and len(hot) <= 20
    plain = sorted(map(str, medallion.consolidate(m, h).collect()))
    assert sorted(map(str, medallion.consolidate(m, h, salt=8, hot=hot).collect())) == plain
    assert sorted(map(str, medallion.consolidate(m, h, salt=8, hot=[]).collect())) == plain
    dm, dh = m.select("policy_id", "doc_no").distinct(), h.select("policy_id", "holder_doc_no").distinct()
    salted_m, salted_h = medallion.salted_sides(dm, dh, 8, hot)
    repeats = {r.policy_id: r.n / r.k for r in salted_h.groupBy("policy_id").agg(F.count("*").alias("n"), F.count_distinct("holder_doc_no").alias("k")).collect()}
    assert all(n == (8 if p in hot else 1) for p, n in repeats.items())
    if hot_share:
        sizes = [r["count"] for r in salted_m.where("policy_id = 7").groupBy("_salt").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_detail_from_files(spark, scratch):
    name = "detail_" + uuid.uuid4().hex[:8]
    df = spark.range(100).withColumn("p", F.col("id") % 4)
    tables.overwrite(df.repartition("p"), name, ["p"], location=scratch + "/a table")
    listed = tables.files(spark, name).collect()
    assert sorted(r.partition for r in listed) == [f"p={i}" for i in range(4)]
    d = tables.detail(spark, name).first()
    assert (d.files, d.partitions, d.versions) == (4, 4, 0)
    assert d.bytes == sum(r.bytes for r in listed) and d.least_file <= d.greatest_file and d.last_change is not None
    versioned = "v_" + uuid.uuid4().hex[:8]
    for n in (1, 3):
        tables.publish_version(spark.range(10).repartition(n), versioned, location_root=scratch + "/v")
    d = tables.detail(spark, versioned).first()
    assert (d.files, d.partitions, d.versions) == (3, 1, 2)

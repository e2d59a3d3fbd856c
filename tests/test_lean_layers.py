"""What the layers shuffle and write: rows once where once is enough, and in parts that fit a task."""

import datetime as dt
import os
import uuid
from collections import Counter

from pyspark.sql import functions as F

from terrace import session
from terrace.operators import layout, upsert
from terrace.plans import bronze, catalog_queries as Q, feeds, medallion, runs
from terrace.sources import drops

from .conftest import SMOKE
from .test_layout_runs import drop_config, small_feeds


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(df):
    return Counter(map(str, df.collect()))


def test_a_dealt_drop_holds_the_same_lines(spark, scratch):
    li = spark.read.parquet(f"{SMOKE}/lineitem.parquet")
    Q.feed_drop(feeds.members_raw(li), medallion.MEMBERS, scratch + "/plain")
    dealt = feeds.members_raw(drops.deal(li, F.trunc("l_shipdate", "month")))
    shuffled = plan(dealt).split("Exchange hashpartitioning(_file")[1]
    assert "batch_" not in shuffled and "l_comment" not in shuffled  # numbers go through it, not the texts
    Q.feed_drop(dealt, medallion.MEMBERS, scratch + "/dealt", dealt=True, compression="gzip")
    read = lambda f: drops.read_drop(spark, f).drop("path")
    assert lines(read(scratch + "/dealt")) == lines(read(scratch + "/plain"))
    files = [f for _, _, fs in os.walk((scratch + "/dealt").replace("file:", "")) for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)


def test_drops_are_loaded_without_a_shuffle_of_their_rows(spark, scratch, monkeypatch):
    cells = spark.range(50).select(
        F.lit("f").alias("file"), F.lit("S").alias("sheet"), F.lit(0).alias("sheet_no"), (F.col("id") + 1).alias("row_no"),
        F.array(F.col("id").cast("string"), F.lit("x")).alias("cells"),
    )
    drops.write_drop(cells, scratch + "/in")
    written = []
    monkeypatch.setattr(bronze, "write_run", lambda rows, *a, _w=bronze.write_run: written.append(a[-1]) or _w(rows, *a))
    files = spark.createDataFrame(
        [(f"{d}/{f}",) for d, _, fs in os.walk(scratch.replace("file:", "") + "/in") for f in fs if f.endswith(".json")], "path string"
    )
    got = bronze.load_drop(spark, scratch + "/in", files, [0, 1], ["a", "b"], scratch + "/raw", "2026-01-15", "r1")
    assert got.rows == 50 and written == [False]
    assert sorted(int(r.a) for r in spark.read.parquet(scratch + "/raw").collect()) == list(range(50))


def test_a_first_load_by_latest_is_not_staged(spark, scratch, monkeypatch):
    staged = []
    monkeypatch.setattr(upsert, "scratch_dir", lambda s, name, _d=upsert.scratch_dir: staged.append(name) or _d(s, name))
    rows = spark.createDataFrame([(1, 1, "a", 1), (1, 1, "b", 2), (2, None, "c", 1), (2, None, "c", 1)], "k long, p int, v string, at int")
    name, args = "lean_" + uuid.uuid4().hex[:8], (["k", "p"], ["p"], False, "latest", ["at"])
    first = upsert.upsert_partitions(rows, name, *args, location=f"{scratch}/t", drop_columns=["at"])
    assert (first.inserted, staged) == (2, [])
    assert sorted(map(str, spark.table(name).select("k", "p", "v").collect())) == ["Row(k=1, p=1, v='b')", "Row(k=2, p=None, v='c')"]
    again = upsert.upsert_partitions(rows, name, *args, drop_columns=["at"])
    assert (again.inserted, again.updated, staged) == (1, 1, ["upsert-stage"])  # a NULL key never matches


def test_clustering_key_does_not_go_through_the_exchange(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7).cast("string").alias("t"), F.lit(dt.date(2024, 1, 1)).alias("d"))
    shuffled = plan(layout.zorder(df, ["t", "id"], 4)).split("Exchange rangepartitioning")[1]
    assert " AS _h" not in shuffled and " AS _z" not in shuffled


def test_a_run_sizes_its_shuffles_for_packed_texts(spark, scratch, monkeypatch):
    m_raw, h_raw = small_feeds(spark)
    cfg, sized = drop_config(scratch), []
    Q.feed_drop(m_raw, medallion.MEMBERS, cfg.members_inbox)
    Q.feed_drop(h_raw, medallion.HOLDERS, cfg.holders_inbox)
    monkeypatch.setattr(runs, "size_shuffle_partitions", lambda s, n, per=session.STORED_BYTES_PER_PARTITION: sized.append((n, per)))
    runs.run_all(spark, cfg, "2026-01-15")
    assert len(sized) == 2 and all(n > 0 and per <= 16 << 20 for n, per in sized)

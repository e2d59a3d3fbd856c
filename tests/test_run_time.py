"""What loads cost: methods the JIT compiles, a batch computed, shuffled and counted once, cells trimmed once."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from terrace.functions import columns as C
from terrace.operators import upsert
from terrace.plans import bronze, catalog_queries as Q, report
from terrace.sources import drops, tables
from terrace.sources import workbooks as wb

from .conftest import SMOKE

HUGE = "spark.sql.codegen.hugeMethodLimit"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def writes(spark, monkeypatch):
    """(limit of generated methods, plan) of every write, in a session that left the limit at Spark's own."""
    seen = []
    for name in ("parquet", "json", "saveAsTable", "insertInto"):

        def spy(self, *a, _w=getattr(DataFrameWriter, name), **k):
            seen.append((int(spark.conf.get(HUGE)), plan(self._df)))
            return _w(self, *a, **k)

        monkeypatch.setattr(DataFrameWriter, name, spy)
    with tables.setting(spark, HUGE, "65535"):
        yield seen
        assert spark.conf.get(HUGE) == "65535"


def test_writes_fall_back_before_a_method_is_too_large_to_compile(spark, scratch, writes):
    rows = spark.createDataFrame([(1, 1, "a")], "k long, p int, v string")
    for _ in range(2):
        upsert.upsert_partitions(rows, "jit_" + uuid.uuid4().hex[:8], ["k", "p"], ["p"], location=f"{scratch}/{len(writes)}")
    upsert.upsert_table(rows, "jit_" + uuid.uuid4().hex[:8], ["k"], location_root=scratch + "/v")
    report.note_changes(rows.withColumnRenamed("k", "policy_id"), scratch + "/changes", "r")
    bronze.write_run(rows.withColumn(bronze.RUN_COL, F.lit("r")), scratch + "/raw", [bronze.RUN_COL])
    cells = spark.range(1).select(
        F.lit("f").alias("file"), F.lit("S").alias("sheet"), F.lit(0).alias("sheet_no"), "id", F.array(F.lit("x")).alias("cells")
    ).withColumnRenamed("id", "row_no")
    drops.write_drop(cells, scratch + "/drop")
    assert len(writes) >= 7 and {limit for limit, _ in writes} == {8000}


def test_a_bucketed_batch_is_computed_and_shuffled_once(spark, scratch, writes):
    name, at, merged = "once_" + uuid.uuid4().hex[:8], upsert.Buckets(3, ("k",)), []
    computed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def costly(v):
        computed.add(1)
        return v

    batches = [[(k, p, str(n), n) for k in range(6) for p in (1, None) for n in range(2)], [(2, 1, "x", 5), (2, 1, "y", 6), (9, 1, "z", 1)]]
    for batch in batches:
        rows = spark.createDataFrame(batch, "k long, p int, v string, at int").withColumn("v", costly.asNondeterministic()("v"))
        with tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            got = upsert.upsert_partitions(
                rows, name, ["k", "p"], ["p"], on_duplicate="latest", order_by=["at"], drop_columns=["at"], location=f"{scratch}/t",
                buckets=at, merged=lambda b: merged.append(b.select("k").distinct().count()),
            )
    assert computed.value == sum(map(len, batches)) and merged == [6, 2]
    into = [p for _, p in writes if "Aggregate" in p]
    assert len(into) == 2 and all(p.count("Exchange hashpartitioning") == 1 for p in into)
    want = {(k, p): "1" for k in range(6) for p in (1, None)} | {(2, 1): "y", (9, 1): "z"}
    # of rows whose key has a NULL part, which never match, each stays once
    want = sorted([(k, p, v) for (k, p), v in want.items()] + [(k, None, "0") for k in range(6)], key=str)
    assert sorted(map(tuple, spark.table(name).select("k", "p", "v").collect()), key=str) == want
    assert (got.inserted, got.updated, got.total) == (1, 1, len(want))


def test_gold_incremental_notes_the_staged_batch(spark, monkeypatch):
    noted = []
    monkeypatch.setattr(report, "note_changes", lambda batch, *a, _n=report.note_changes: noted.append(plan(batch)) or _n(batch, *a))
    monkeypatch.setattr(report, "refresh_changed", lambda *a, **k: (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):  # after the first load of both feeds
        Q.gold_incremental(spark, SMOKE)
    assert len(noted) == 2 and all("upsert-stage" in p and "lineitem" not in p and "orders" not in p for p in noted)


def test_edge_space_is_stripped_as_python_strips_it(spark):
    space = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    texts = [s + "a" + t + "b" + s for s in space for t in (" ", "\n")] + ["", "".join(space), " a", "b\n", "퟿​", None]
    got = spark.createDataFrame([(t,) for t in texts], "x string").select(C.strip_space("x").alias("y"))
    assert [r[0] for r in got.collect()] == [t if t is None else t.strip() for t in texts]
    assert "regexp_replace" not in plan(got)  # a pattern is tried at every place of a text


def test_rows_are_trimmed_once_and_blank_ones_found_by_their_first_text(spark):
    cells = [["a", None], [" \t", "b "], ["　", ""], [None, None], [" c", " "]]
    rows = spark.createDataFrame([("d/f", "S", 0, i, 2, c, None) for i, c in enumerate(cells, 1)], (
        "path string, sheet string, sheet_no int, row_no long, width int, cells array<string>, problem string"
    )).withColumn("accepted", F.lit(True))
    got = wb.to_rows(rows, [0, 1], ["x", "y"])
    assert sorted(map(str, got.select("x", "y").collect())) == sorted(["Row(x='a', y=None)", "Row(x='', y='b')", "Row(x='c', y='')"])
    assert "concat_ws" not in plan(got) and plan(got).count("trim(both") + plan(got).count("btrim(") <= 4

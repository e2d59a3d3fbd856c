"""Every stage against brute force on its own input; the queries with SQL against DuckDB."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from terrace.llm import queries
from terrace.llm.tables import scratch, stored, table
from terrace.llm.words import BATCH_ROWS
from tests.conftest import SMOKE
from tests.llm.conftest import odd_rows, prose
from tests.llm.test_decontaminate import brute_distance
from tests.llm.test_mixing import brute_targets
from tests.llm.test_quality_rules import brute
from tests.llm.test_simhash import brute_groups
from tests.test_oracle import canon


@pytest.fixture(scope="module")
def stages(spark):
    """(input rows, output rows) of each stage."""
    docs, out = table(spark, SMOKE, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        made = stored(stage(spark, docs, SMOKE), "test-stage")
        out.append((docs.collect(), made.collect()))
        docs = made
    return out


def test_all_but_the_last_stage_keep_the_columns(stages):
    for (before, after) in stages[:-1]:
        assert after and after[0].__fields__ == before[0].__fields__


def test_quality_stage(stages):
    before, after = stages[0]
    want = set()
    for r in before:
        n, _, _, _, repeat, covered, longest = brute(r.text, 5)
        if n >= 50 and 100 * repeat <= 50 * n and covered <= 0.4 * n and longest <= 100:
            want.add(r)
    assert set(after) == want and len(after) == len(want) < len(before)


def test_simhash_stage(stages):
    before, after = stages[1]
    groups = brute_groups([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({g[2] for g in groups})
    assert set(after) <= set(before)


def test_decontamination_stage(stages, spark):
    before, after = stages[2]
    items = [r.text.lower().split() for r in table(spark, SMOKE, "benchmark").collect()]
    kept = {r.doc_id for r in after}
    assert set(after) <= set(before) and 0 < len(before) - len(after) < 0.2 * len(before)
    for r in before:
        words = r.text.lower().split()
        if r.doc_id in kept:
            assert not any(f" {' '.join(i)} " in f" {' '.join(words)} " for i in items)
        else:
            assert any(brute_distance(i, words) <= int(0.2 * len(i)) for i in items)


def test_mixing_stage(stages):
    before, after = stages[3]
    assert set(after) <= set(before)
    times = {r: after.count(r) for r in before}
    assert max(times.values()) <= 3
    names = sorted({r.source for r in before})
    size = {r: len(r.text.split()) for r in before}
    sizes = [sum(size[r] for r in before if r.source == s) for s in names]
    targets = brute_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 3)
    for s, t in zip(names, targets):
        own = [r for r in before if r.source == s]
        # to the nearest document: half of the smallest one left out
        assert abs(sum(size[r] * times[r] for r in own) - t) <= max(size[r] for r in own) / 2 + 1


def test_sharding_stage(stages):
    before, after = stages[4]
    assert sorted((r.doc_id, r.text) for r in after) == sorted((r.doc_id, r.text) for r in before)
    slots = {}
    for r in after:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, [])) for s in range(40)]
    assert max(counts) - min(counts) <= 1


def test_stages_take_odd_rows_clashing_names_and_empty_tables(spark, make_docs):
    rows = odd_rows(random.Random(30)) + [(100 + i, prose(random.Random(i), 90, 10**6), None) for i in range(4)]
    docs = make_docs(rows).withColumnsRenamed({"lang": "shard", "n_chars": "size"}).withColumn("order", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stored(stage(spark, docs, SMOKE), "test-odd")
        assert made.columns == docs.columns and {r.doc_id for r in made.collect()} <= {r[0] for r in rows}
        assert stage(spark, docs.limit(0), SMOKE).collect() == []
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SMOKE).count() == len(rows)
    assert last(spark, docs.limit(0), SMOKE).collect() == []


def test_run_gives_the_last_stage(stages, spark):
    got = corpus_pipeline.run(spark, SMOKE).collect()
    assert sorted(map(str, got)) == sorted(map(str, stages[-1][1]))


def test_run_leaves_one_stage_and_the_numbers_of_the_last(stages, spark):
    root, rows = spark.conf.get("spark.checkpoint.dir"), spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, "10000")
    before = set(os.listdir(root))
    try:
        corpus_pipeline.run(spark, SMOKE).count()
        assert spark.conf.get(BATCH_ROWS) == "10000"
    finally:
        spark.conf.set(BATCH_ROWS, rows)
    left = sorted({name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before})
    assert "pipeline-3" in left and len(left) == 2


@pytest.mark.parametrize("key", ["op1_suffix_dedup", "op7_splitting_tree_mix", "op10_simhash", "op13_spelling_variants"])
def test_scratch_owns_what_a_query_leaves(spark, key):
    root, rows = spark.conf.get("spark.checkpoint.dir"), spark.conf.get(BATCH_ROWS)
    before = set(os.listdir(root))
    with scratch(spark):
        inside = queries.QUERIES[key](spark, SMOKE).collect()
        assert set(os.listdir(root)) > before
    assert inside and set(os.listdir(root)) == before and spark.conf.get(BATCH_ROWS) == rows
    with pytest.raises(ZeroDivisionError), scratch(spark):
        stored(spark.range(3), "gone")
        1 / 0  # noqa: B018
    assert set(os.listdir(root)) == before


def test_queries_are_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(E.queries())


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_sql(spark, key):
    duck = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    df = queries.QUERIES[key](spark, SMOKE)
    rel = duck.sql(queries.ORACLE_SQL[key])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())

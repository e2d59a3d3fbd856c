"""Targets, exact splitting, closeness, disjoint draws, reruns."""

import random

import numpy as np
import pytest

from terrace.llm import mixing
from tests.llm.conftest import odd_rows, prose


def brute_targets(sizes, weights, most):
    """Raise one common level until all words are dealt out."""
    lo, hi = 0.0, sum(sizes) + 1.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(most * s, mid * w) for s, w in zip(sizes, weights)) < sum(sizes):
            lo = mid
        else:
            hi = mid
    return [min(most * s, lo * w) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("seed", range(8))
def test_targets(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 5, 100, 10_000, 300_000]) * rng.randrange(1, 5) for _ in range(rng.randrange(1, 12))]
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    got = mixing.targets(np.array(sizes), np.array(weights, float), 3)
    assert got.tolist() == pytest.approx(brute_targets(sizes, weights, 3), abs=1e-3)
    assert got.sum() == pytest.approx(sum(sizes))


def test_splitting_tree_is_exact_and_fair():
    quotas = np.array([1000, 0, 37, 5])
    split = mixing.split_tree(quotas, 7)
    assert (split.sum(axis=0) == quotas).all()
    totals = split.sum(axis=1)
    assert totals.max() - totals.min() <= 1
    many = np.array([mixing.split_tree(quotas, 4, seed)[:, 2] for seed in range(400)])
    assert abs(many.mean() - 37 / 4) < 0.3  # every shard has the same expected share
    assert (mixing.split_tree(quotas, 7) == split).all()


def test_large_populations_are_drawn_in_parts():
    quota = np.array([900, 0, 77, 23])
    draws = np.array([mixing.drawn_from(quota, 300, np.random.default_rng(seed), most=130) for seed in range(300)])
    assert (draws.sum(axis=1) == 300).all() and (draws <= quota).all() and (draws >= 0).all()
    assert np.abs(draws.mean(axis=0) - quota * 0.3).max() < 1.5
    huge = np.array([6 * 10**9, 5, 10**9 + 1])
    split = mixing.split_tree(huge, 5)
    assert (split.sum(axis=0) == huge).all() and np.ptp(split.sum(axis=1)) <= 1
    same = mixing.drawn_from(quota, 300, np.random.default_rng(4))  # one part: numpy's own draw
    assert (same == np.random.default_rng(4).multivariate_hypergeometric(quota, 300, method="marginals")).all()


def corpus(rng):
    rows = []
    for s, n in (("a", 400), ("b", 900), ("c", 30), ("é", 200), (None, 120)):
        rows += [(len(rows) + i, prose(rng, int(rng.paretovariate(1.2) * 20) + 1), s) for i in range(n)]
    return rows


def test_words_taken_come_near_the_targets(make_docs):
    rows = corpus(random.Random(10))
    got = mixing.digest(make_docs(rows)).collect()
    again = mixing.digest(make_docs(rows[::-1]).repartition(5)).collect()
    assert sorted(got) == sorted(again)
    names = ["a", "b", "c", "é", None]
    sizes = [sum(len(r[1].split()) for r in rows if r[2] == s) for s in names]
    expected = brute_targets(sizes, [5, 2, 1, 5, 2], 3)
    source = {r[0]: names.index(r[2]) for r in rows}
    taken = [0] * 5
    for r in got:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (len(rows[r.doc_id][1].split()), sizes[s])
        assert r.target == pytest.approx(expected[s], abs=1e-3)
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for t, e in zip(taken, expected):
        assert abs(t - e) <= max(25, 0.005 * e)


def test_shards_get_their_quotas(make_docs):
    mixed = mixing.mix(make_docs(corpus(random.Random(11))), shards=8)
    drawn = mixing.drawn(mixed).toPandas()
    assert set(drawn["shard"]) == set(range(8))
    words = drawn.groupby("shard")["size"].sum()
    assert words.max() < 2.5 * words.min()  # blocks are dealt evenly; texts differ a hundredfold in size
    assert (drawn.groupby(["doc_id", "shard"]).size() <= 3).all()
    assert mixing.laid_out(mixed).count() == len(drawn)


def test_odd_rows_and_empty_table(make_docs):
    rows = odd_rows(random.Random(12))
    got = mixing.digest(make_docs(rows)).collect()
    assert len(got) == len(rows)
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert sum(r.taken for r in got) == pytest.approx(sum(r["size"] for r in got), rel=0.01)  # one source: all of it
    assert mixing.digest(make_docs([])).collect() == []
    assert {(r["size"], r.target, r.taken) for r in mixing.digest(make_docs([(1, None), (2, "")])).collect()} == {(0, 0.0, 0)}
    clash = make_docs(rows).withColumnsRenamed({"lang": "size", "n_chars": "shards"})
    assert mixing.mix(clash).columns == ["doc_id", "text", "source", "size", "source_size", "target", "shards"]


def test_a_very_long_document_leaves_no_gap(make_docs):
    """Without it in the partial pass, the words come from documents further down the order."""
    rng = random.Random(13)
    rows, want = [], {}
    for s in "abcdefgh":  # the order puts the long document in another place in each source
        rows += [(len(rows) + i, "w " * rng.randrange(2, 14), s) for i in range(1500)]
        rows += [(len(rows), "w " * 9_000, s)]
    got = mixing.digest(make_docs(rows)).collect()
    taken = {}
    for r in got:
        s = rows[r.doc_id][2]
        want[s] = r.target
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(14, 0.002 * t), (s, taken[s], t)


def test_digest_and_layout_carry_the_draws(make_docs):
    docs = make_docs([(i, prose(random.Random(i), 20), "ab"[i % 2]) for i in range(200)])
    rows = mixing.laid_out(mixing.mix(docs, prefix="m_"), "m_").collect()
    assert [(r.m_shard, r.m_order) for r in rows] == sorted((r.m_shard, r.m_order) for r in rows)
    digest = {(r.doc_id, k, s, o) for r in mixing.digest(docs).collect() for k, (s, o) in enumerate(zip(r.shards, r.orders))}
    assert digest == {(r.doc_id, r.m_copy, r.m_shard, r.m_order) for r in rows}

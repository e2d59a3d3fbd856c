"""Items in documents against brute force (Sellers' distance at every place)."""

import random

import numpy as np
import pytest

from terrace.llm import decontaminate as dc
from tests.llm.conftest import odd_rows, prose


def brute_distance(item, words):
    """Least edit distance of ``item`` to any stretch of ``words``."""
    column = list(range(len(item) + 1))
    best = column[-1]
    for w in words:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(new[i] + 1, column[i + 1] + 1, column[i] + (x != w)))
        column, best = new, min(best, new[-1])
    return best


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        k, kind = rng.randrange(len(words)), rng.randrange(3)
        words[k : k + (kind != 0)] = [] if kind == 1 and len(words) > 1 else [f"n{rng.randrange(10**7)}"]
    return words


@pytest.fixture(scope="module")
def bench(spark):
    rng = random.Random(19)
    rows = [(i, prose(rng, rng.randrange(15, 70))) for i in range(40)]
    rows += [(100, "short item here"), (101, "Only four words here"), (102, ""), (103, None), (104, "one")]
    rows += [(0, rows[0][1])]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def expected(rows, items):
    out = set()
    for i, text in rows:
        words = (text or "").lower().split()
        for k, item in items:
            item = (item or "").lower().split()
            if item and brute_distance(item, words) <= int(0.2 * len(item)):
                out.add((i, k))
    return out


def test_exact_items_are_always_found_and_nothing_else(make_docs, bench):
    rng = random.Random(20)
    items, frame = bench
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(40))]
        if i % 2:
            parts += [rng.choice(items)[1] or "", prose(rng, rng.randrange(40))]
        text = " ".join(parts)
        rows.append((i, text.upper() if i % 5 == 0 else text))
    got = dc.digest(make_docs(rows), frame).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected(rows, items)
    words = {i: t.lower().split() for i, t in rows}
    exact = {i: (t or "").lower().split() for i, t in items}
    for r in got:
        if r.distance == 0:
            assert words[r.doc_id][r.start : r.start + r.words] == exact[r.item_id]


def test_recall_under_edits_and_exact_distances(make_docs, bench):
    rng = random.Random(21)
    items, frame = bench
    long = [(k, t.split()) for k, t in items[:40]]
    rows = []
    for i in range(200):
        k, words = long[i % 40]
        body = edited(rng, words, rng.randrange(int(0.2 * len(words)) + 1))
        rows.append((i, " ".join(prose(rng, 12).split() + body + prose(rng, 12).split())))
    want = expected(rows, items)
    got = {(r.doc_id, r.item_id): r.distance for r in dc.digest(make_docs(rows), frame).collect()}
    assert set(got) <= want
    assert len(set(got) & want) >= 0.95 * len(want)
    texts, by_id = dict(rows), dict(items)
    for (i, k), d in got.items():
        assert d >= brute_distance(by_id[k].split(), texts[i].split())


def test_clean_and_blocks(make_docs, bench, monkeypatch):
    items, frame = bench
    rows = [(1, f"a b {items[3][1]} c"), (2, "nothing to see"), (3, None), (4, items[7][1].upper())]
    assert sorted(r.doc_id for r in dc.clean(make_docs(rows), frame).collect()) == [2, 3]
    assert dc.clean(make_docs(rows), frame).columns == make_docs([]).columns
    whole = sorted(map(tuple, dc.digest(make_docs(rows), frame).collect()))
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 20)
    assert sorted(map(tuple, dc.digest(make_docs(rows), frame).collect())) == whole


def test_odd_rows_and_empty_tables(make_docs, bench, spark):
    rows = odd_rows(random.Random(22))
    items, frame = bench
    got = {(r.doc_id, r.item_id) for r in dc.digest(make_docs(rows), frame).collect()}
    assert got == expected(rows, items) == {(4, 104), (None, 104)} - {(None, 104)}
    assert dc.digest(make_docs([]), frame).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.digest(make_docs(rows), none).collect() == []
    assert dc.clean(make_docs(rows), none).count() == len(rows)


def test_walk_is_the_same_for_equal_windows():
    rng = np.random.default_rng(23)
    item = rng.integers(1 << 62, size=20).astype(np.uint64)
    items = dc.Items([1], [item])
    assert items.window == 16 and 1 <= len(items.tables) <= dc.MAX_REPETITIONS
    text = np.concatenate([rng.integers(1 << 62, size=30).astype(np.uint64), item])
    for r in range(len(items.tables)):
        at, _ = dc.agreeing(text, np.arange(len(text) - items.window + 1), items, r)
        assert 30 in at


def test_items_of_every_length_are_found_with_their_first_word_edited(make_docs, spark):
    rng = random.Random(24)
    items, rows = [], []
    for n in [*range(5, 24)] * 5:
        words = [f"v{rng.randrange(10**6)}" for _ in range(n)]
        k = len(items)
        items.append((k, " ".join(words)))
        pad = prose(rng, 20)
        rows.append((2 * k, f"{pad} {' '.join(['odd', *words[1:]])} {pad}"))
        rows.append((2 * k + 1, f"{pad} {' '.join(words[1:])} {pad}"))
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.digest(make_docs(rows), frame).collect()}
    for n in range(5, 24):
        want = {(2 * k + e, k) for k, t in items for e in (0, 1) if len(t.split()) == n}
        assert len(want & got) >= 0.9 * len(want), n


def test_recall_is_measured_at_every_length(monkeypatch):
    rng = np.random.default_rng(25)
    tokens = [rng.integers(1 << 62, size=n).astype(np.uint64) for n in (3, 5, 7, 8, 10, 15, 16, 20, 33, 59, 300)]
    for items in dc.grouped(list(range(len(tokens))), tokens):
        assert len(items.recall) == len({*dc.length_class(items.length).tolist()})
        assert min(items.recall.values()) >= dc.RECALL
    monkeypatch.setattr(dc, "MAX_REPETITIONS", 1)
    with pytest.warns(UserWarning, match="recall below"):  # one window only: its first word must not be edited
        dc.Items([1], [tokens[6]])


def test_words_that_share_a_code_do_not_drop_a_match():
    rng = np.random.default_rng(26)
    item = rng.integers(1 << 62, size=20).astype(np.uint64)
    item[1] = item[0] + np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))  # the same code but in rare cases
    assert dc.pair_code(np.array(0), item[:1]) == dc.pair_code(np.array(0), item[1:2])
    (items,) = dc.grouped([1], [item])
    text = item.copy()
    text[16:] = rng.integers(1 << 62, size=4).astype(np.uint64)  # as many edits as the limit

    class Texts:
        hash, first, n_words = text, np.array([0, 20]), np.array([20])

        def rows(self):
            return np.zeros(20, np.int64)

    assert dc.verified(Texts(), items, *dc.candidates(Texts(), items))[0, 0][0] == 4


def test_items_that_repetitions_miss_are_found_exactly(make_docs, spark, monkeypatch):
    """One repetition misses the target at most lengths; the pieces find all there, also beside odd texts."""
    monkeypatch.setattr(dc, "MAX_REPETITIONS", 1)
    rng = random.Random(27)
    items, rows = [], []
    for n in [3, 5, 6, 9, 10, 14, 15, 20, 31, 47, 64] * 4:
        words = [f"v{rng.randrange(10**6)}" for _ in range(n)]
        k = len(items)
        items.append((k, " ".join(words)))
        body = " ".join(edited(rng, words, int(0.2 * n)))
        rows += [(3 * k, f"{prose(rng, 20)} {body} {prose(rng, 9)}"), (3 * k + 1, body), (3 * k + 2, " ".join(words[: n // 2]))]
    rows += [(1000 + i, text) for i, (_, text) in enumerate(odd_rows(rng))]
    frame = spark.createDataFrame(items, "item_id long, text string")
    with pytest.warns(UserWarning, match="searched exactly"):
        got = {(r.doc_id, r.item_id): r.distance for r in dc.digest(make_docs(rows), frame).collect()}
    want = {
        (i, k)
        for i, k in ((i, k) for k, _ in items for i in (3 * k, 3 * k + 1, 3 * k + 2))
        if brute_distance(dict(items)[k].split(), dict(rows)[i].split()) <= int(0.2 * len(dict(items)[k].split()))
    }
    # items over 31 words have so many windows that one repetition reaches the target, not all
    assert {w for w in want if len(dict(items)[w[1]].split()) < 32} <= set(got) <= want
    assert len(got) >= 0.9 * len(want) >= 72

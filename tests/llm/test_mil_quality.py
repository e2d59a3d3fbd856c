"""Held-out accuracy, no leak of labels or ids into scores, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa

from terrace.llm import mil_quality as mq
from terrace.llm.tables import table
from tests.conftest import SMALL
from tests.llm.conftest import odd_rows, prose


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    got = mq.digest(docs, labels).join(labels, "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held_out))
    held = got[got.held_out]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert len(good) > 40 and len(bad) > 5
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert (held.predicted == held.quality).mean() > 0.95
    assert (got.predicted == (got.score >= 0.3)).all()


def junk_and_clean(rng):
    rows, labels = [], []
    for i in range(160):
        good = i % 4 != 0
        text = prose(rng, 150, 10**5) if good else "!! ".join(prose(rng, 90, 10**5).upper().split())
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_one_bad_passage_among_many(make_docs):
    """Only the text matters; attention finds the passages that speak."""
    rng = random.Random(14)
    rows, labels = junk_and_clean(rng)
    docs = make_docs(rows)
    model = mq.train(docs, docs.sparkSession.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    texts = [(1000, rows[1][1]), (77, rows[1][1]), (2000, rows[0][1]), (3000, "")]
    scores = {r.doc_id: r.score for r in mq.score(make_docs(texts), model, ["doc_id"]).collect()}
    assert scores[1000] == scores[77] > 0.9
    assert scores[2000] < 0.1
    assert 0 <= scores[3000] <= 1


def test_words_tell_where_counts_do_not(make_docs):
    """Good and bad texts are drawn alike from two lists of words of the same shape: only the words differ."""
    rng = random.Random(18)
    name = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    pools = [sorted({name() for _ in range(150)}) for _ in range(2)]
    rows = [(i, " ".join(rng.choices(pools[i % 2], k=130))) for i in range(300)]
    docs = make_docs(rows)
    labels = docs.sparkSession.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = mq.digest(docs, labels).where("held_out").collect()
    assert len(got) > 40
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in got) > 0.95 * len(got)


def test_word_sums_against_a_plain_count():
    rng = random.Random(19)
    texts = [prose(rng, 150), "", None, "a b a"]
    _, _, data, offsets = next(mq.chunks(pa.array(texts)))
    x, row = mq.passage_features(data, offsets)
    words = mq.Words(data, offsets)
    assert row.tolist() == [0, 0, 0, 1, 2, 3]
    for p in range(len(row)):
        lo = int(words.first[row[p]]) + 64 * (p - row.tolist().index(row[p]))
        own = words.hash[lo : min(lo + 64, int(words.first[row[p] + 1]))]
        plain = np.zeros(mq.SLOTS)
        for key in mq.mix(own ^ np.uint64(0xA24BAED4963EE407)).tolist():
            plain[key % mq.SLOTS] += 1 if key >> 63 else -1
        plain = np.minimum(plain / max(1, len(own)) ** 0.5, 4)
        assert np.allclose(x[p, len(mq.FEATURES) :], plain, atol=1e-6)


def test_training_takes_evenly_spaced_passages():
    row = np.repeat(np.arange(4), [1, 5, 200, 8])
    some = mq.evenly(row, 8)
    assert [int(some[row == k].sum()) for k in range(4)] == [1, 5, 8, 8]
    assert np.diff(np.flatnonzero(some[row == 2])).tolist() == [25] * 7
    assert mq.evenly(row[:0], 8).tolist() == []


def test_gradient(make_docs):
    rng = np.random.default_rng(15)
    x, bounds, y = rng.normal(size=(12, 5)), np.array([0, 3, 4, 9]), np.array([1.0, 0, 1, 0])
    loss = lambda m: -np.mean(np.log(np.where(y == 1, (s := m.forward(x, bounds)["score"]), 1 - s)))
    model = mq.Model(5)
    before = loss(model)
    model.fit(x, bounds, y)
    assert loss(model) < 0.2 * before


def test_odd_rows_and_empty_tables(make_docs, spark):
    rows = odd_rows(random.Random(16))
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in mq.digest(make_docs(rows), no_labels).collect()} == {0.5}
    labels = spark.createDataFrame([(6, 1, 0), (8, 0, 0), (9, None, 0), (None, 1, 1), (4, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    got = mq.digest(make_docs(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert mq.digest(make_docs([]), labels).collect() == []


def test_every_gradient_against_finite_differences(monkeypatch):
    """The first Adam step moves each parameter by the rate against its gradient's sign: all seven arrays are checked."""
    monkeypatch.setattr(mq, "EPOCHS", 1)
    monkeypatch.setattr(mq, "DECAY", 0.0)
    rng = np.random.default_rng(17)
    x, bounds, y = rng.normal(size=(14, 6)), np.array([0, 4, 5, 9]), np.array([1.0, 0, 1, 0])
    still, stepped = mq.Model(6), mq.Model(6)
    stepped.fit(x, bounds, y)
    still.mean, still.scale = stepped.mean, stepped.scale

    def loss():
        s = still.forward(x, bounds)["score"]
        return -np.mean(np.log(np.where(y == 1, s, 1 - s)))

    checked = 0
    for name, values in still.p.items():
        moved = (stepped.p[name] - values).ravel()
        flat = values.reshape(-1)
        for k in range(flat.size):
            old = flat[k]
            flat[k] = old + 1e-5
            above = loss()
            flat[k] = old - 1e-5
            below = loss()
            flat[k] = old
            slope = (above - below) / 2e-5
            if abs(slope) > 1e-6:
                checked += 1
                assert np.isclose(moved[k], -np.sign(slope) * mq.RATE, rtol=0.02), (name, k)
    assert checked > 0.8 * sum(v.size for v in still.p.values())

"""The kernel against enumeration, the optimisers' gradients, held-out accuracy, inserted characters, odd rows."""

import random
import re
import zlib
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from terrace.llm import toxicity as tx
from terrace.llm.tables import table
from tests.llm.conftest import odd_rows

MEDIUM = "/root/testdata/sf0.1"
INSULTS = "trash pathetic idiot disgusting worthless stupid clown scum loser moron".split()


def slow_features(word):
    letters = ["^", *re.findall("[a-z]", word.lower()), "$"]
    out = {}
    for places in combinations(range(len(letters)), tx.LETTERS):
        span = places[-1] - places[0] + 1
        if span <= tx.SPAN:
            out.setdefault("".join(letters[p] for p in places), []).append(tx.DECAY ** (span - tx.LETTERS))
    return out


def slow_kernel(a, b):
    x, y = slow_features(a), slow_features(b)
    norm = lambda f: sum(w * w for ws in f.values() for w in ws) ** 0.5
    total = sum(sum(x[u]) * sum(y[u]) for u in x.keys() & y.keys())
    return (total / norm(x) / norm(y)) ** tx.POWER if total else 0.0


def test_kernel_against_enumeration():
    words = ["idiot", "i.d.i.o.t", "idxiot", "IDIOT", "banana", "bananas", "an", "ana", "idioticidiot", "--moron!!", "zzz"]
    units = tx.joined([" ".join(words).encode()])
    marks = tx.Landmarks(units, np.array([0, 4, 9]))
    got = marks.kernel(units, np.arange(len(words)))
    expect = [[slow_kernel(w, v) for v in ("idiot", "banana", "moron")] for w in words]
    assert np.allclose(got, expect, atol=1e-4)
    assert got[1, 0] > 0.99 and got[3, 0] > 0.99 and got[2, 0] > 0.1 > got[4, 0]


def test_words_and_sentences():
    text = "You i d i o t go. On a b now!\nNew line here  \n\n" + "w " * 2 + "long " * 60
    units = tx.joined([text.encode(), b"", b"x y z"])
    words = [units.data[a:b].tobytes().decode() for a, b in zip(units.starts, units.ends)]
    assert words[:7] == ["You", "i d i o t", "go.", "On", "a", "b", "now!"]
    assert words[-1] == "x y z" and units.row[-1] == 2 and (units.row != 1).all()
    sentences = [list(range(a, b)) for a, b in zip(*(lambda c: (c, [*c[1:], len(words)]))(np.flatnonzero(np.diff(units.sentence, prepend=-1)).tolist()))]
    assert [words[i] for i in sentences[0]] == ["You", "i d i o t", "go."]
    assert [words[i] for i in sentences[2]] == ["New", "line", "here"]
    assert max(map(len, sentences)) == tx.SENTENCE
    assert units.hash[1] != tx.joined([b"i d i o x"]).hash[0]


def test_optimisers_end_where_the_gradient_is_zero():
    rng = np.random.default_rng(1)
    x = np.hstack([rng.normal(size=(300, 5)), np.ones((300, 1))]).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=300) > 0.4, 1.0, -1.0)
    cost = np.where(y > 0, 2.0, 0.5)

    def loss(w):
        ridge = np.r_[np.full(5, tx.RIDGE), 1e-6]
        return (cost * np.maximum(1 - y * (x @ w), 0) ** 2).sum() + (ridge * w * w).sum()

    w = tx.squared_hinge(x, y, cost)
    steps = np.eye(6) * 1e-4
    assert max(abs(loss(w + s) - loss(w - s)) / 2e-4 for s in steps) < 1e-2 * loss(w)
    features = np.hstack([np.ones((300, 1)), rng.normal(size=(300, 3))])
    label = (features[:, 1] + rng.normal(size=300) > 0).astype(float)
    p = tx.logistic(features, label, 0.3)
    weight = np.where(label > 0, 0.3 / label.sum(), 0.7 / (1 - label).sum())
    chance = 1 / (1 + np.exp(-features @ p))
    assert np.abs(features.T @ (weight * (chance - label)) + np.r_[1e-6, 1e-3, 1e-3, 1e-3] * p).max() < 1e-6


def test_held_out_accuracy_and_inserted_characters(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    machine = tx.train(docs, labels)
    held = docs.join(labels, "doc_id").where(tx.held_out(F.col("doc_id")) & (F.col("lang") == "en")).toPandas()
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id)
    machine_scores = lambda texts: machine.documents(machine.summaries(tx.joined([t.encode() for t in texts])))
    scores, toxic = machine_scores(held.text), held.toxic.to_numpy()
    assert toxic.sum() > 40
    assert (scores[toxic == 0] < 0.5).mean() > 0.97
    # labels are noisy: one toxic document in ten has no insult at all
    told = np.array([any(w in t.lower() for w in INSULTS) for t in held.text])
    assert (scores[(toxic == 1) & told] >= 0.5).mean() > 0.97
    texts = held.text[(toxic == 1) & told]
    for change, least in (
        (".".join, 0.97),
        (" ".join, 0.85),
        ("**".join, 0.97),
        (str.upper, 0.97),
        (lambda w: w[:2] + "-" + w[2:], 0.97),
        (lambda w: w[:3] + w[2] * 2 + w[3:], 0.8),
        (lambda w: w[:2] + "z" + w[2:], 0.55),
        (lambda w: w[: len(w) // 2] + "q" + w[len(w) // 2 :], 0.3),
    ):
        altered = [re.sub("|".join(INSULTS), lambda m: change(m[0]), t) for t in texts]
        assert (machine_scores(altered) >= 0.5).mean() >= least


def test_letters_put_in():
    got = tx.with_letters(b"dolt")
    assert len(got) == 4 and all(len(w) == 5 and w[:2] == b"do" and any(w[:k] + w[k + 1 :] == b"dolt" for k in range(5)) for w in got)
    assert tx.with_letters(b"ab") == [b"ab"] and len(tx.with_letters(b"a b c")[0]) == 4


def test_altered_sentences_have_the_features_of_their_spelling():
    """Each copy's features are the sums over the words of a sentence that is spelt out with letters put in."""
    units = tx.joined([b"you dolt there", b"a nitwit, a dolt", b"fine words"])
    first, which = units.distinct()
    spelt = [units.data[units.starts[k] : units.ends[k]].tobytes() for k in first]
    telling = np.array([w in (b"dolt", b"nitwit,") for w in spelt])
    marks = tx.Landmarks(units, first)
    features = lambda u: marks.kernel(u, np.arange(len(u.starts)))
    z, bounds = marks.kernel(units, first), [(0, 3), (3, 7)]
    x = np.array([np.append(z[which[lo:hi]].sum(axis=0), 1) for lo, hi in bounds])
    got = tx.altered(units, first, which, z, features, telling, bounds, x)
    assert got.shape == (2 * tx.COPIES, x.shape[1]) and (got[:, -1] == 1).all()
    options = [
        [f"you {w} there" for w in map(bytes.decode, tx.with_letters(b"dolt"))],
        [f"a {v} a {w}" for v in map(bytes.decode, tx.with_letters(b"nitwit,")) for w in map(bytes.decode, tx.with_letters(b"dolt"))],
    ]
    for i, row in enumerate(got):
        sums = [features(tx.joined([o.encode()])).sum(axis=0) for o in options[i // tx.COPIES]]
        assert any(np.allclose(row[:-1], s, atol=1e-4) for s in sums)
    assert not np.allclose(got[0], got[1])


def labelled(rng):
    rows, labels = [], []
    for i in range(240):
        words = [rng.choice(["stone", "river", "window", "paper", "garden", "evening"]) + rng.choice(["", "s", "y"]) for _ in range(40)]
        if i % 3 == 0:
            words[rng.randrange(40)] = rng.choice(["dunderhead", "Nincompoop"])
        rows.append((i, " ".join(words) + "."))
        labels.append((i, 1, int(i % 3 == 0)))
    return rows, labels


def test_only_the_text_matters(make_docs, spark):
    rows, labels = labelled(random.Random(2))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    machine = tx.train(make_docs(rows), labels)
    texts = ["a river and a nincompoop.", "a river and a d.u.n.d.e.r.h.e.a.d", "a river and a window.", ""]
    got = {(r.doc_id, r.text): r.score for r in tx.score(make_docs([(k, t) for k in (1000, 77) for t in texts]), machine, ["doc_id", "text"]).collect()}
    assert all(got[1000, t] == got[77, t] for t in texts)
    assert min(got[77, t] for t in texts[:2]) > 0.5 > max(got[77, t] for t in texts[2:])
    again = tx.train(make_docs(list(reversed(rows))), labels)
    assert np.array_equal(machine.weights, again.weights) and np.array_equal(machine.platt, again.platt)
    assert tx.sample(make_docs(rows * 3), labels, max_docs=10).count() <= 20


def test_a_task_remembers_words(make_docs, spark):
    rows, labels = labelled(random.Random(3))
    machine = tx.train(make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    memory, old = tx.Memory(machine), tx.REMEMBERED
    tx.REMEMBERED = 8
    try:
        for at in range(0, 60, 7):
            units = tx.joined([t.encode() for _, t in rows[at : at + 7]])
            first, which = units.distinct()
            assert np.allclose(memory.scores_of(units), machine.word_scores(units, first)[which], atol=1e-5)
    finally:
        tx.REMEMBERED = old


def test_odd_rows_and_empty_tables(make_docs, spark):
    kind = "doc_id long, quality int, toxic int"
    rows = odd_rows(random.Random(4))
    assert {r.score for r in tx.digest(make_docs(rows), spark.createDataFrame([], kind)).collect()} == {0.0}
    few = spark.createDataFrame([(6, 1, 0), (8, 0, 1), (9, None, None), (None, 1, 1)], kind)
    assert len(tx.digest(make_docs(rows), few).collect()) == len(rows)
    more, labels = labelled(random.Random(5))
    more = [(i + 100, t) for i, t in more]
    labels = spark.createDataFrame([(i + 100, q, t) for i, q, t in labels], kind)
    docs = make_docs(rows + more).withColumns({c: F.lit("x") for c in ("score", "toxic", "mark", "id", "held_out", "predicted", "__text")})
    got = tx.digest(docs, labels).collect()
    assert len(got) == len(rows) + len(more) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert tx.digest(make_docs([]), labels).collect() == []

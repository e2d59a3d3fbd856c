"""Letters, CRC and cuts against plain versions; the whole query against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from terrace.llm import spelling
from terrace.llm.kdtree import KdTree
from terrace.llm.tables import stored, table
from tests.conftest import SMOKE
from tests.llm.conftest import odd_rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def slow_words(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow(words):
    near = {}
    for w in words:
        near[w] = [v for v in words if abs(len(v) - len(w)) < 2 and v != w and one_edit(w, v)]
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top and words[top] >= 5 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words)


def variants_of(spark, words, **sizes):
    df = stored(spark.createDataFrame([(bytearray(w.encode("latin-1")), n) for w, n in words.items()], "w binary, n long"), "test")
    text = lambda b: None if b is None else bytes(b).decode("latin-1")
    return sorted(
        (text(r.w), text(r.form), text(r.root), r.n, r.n_near, r.form_n) for r in spelling.variants(df, **sizes).collect()
    )


def test_whole_query(spark):
    docs = table(spark, SMOKE, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling.digest(docs).collect()]
    words = slow_words(rows)
    assert len(words) > 200
    assert sorted(got) == slow(words)


def random_words(rng, n):
    """Clusters of variants, anagrams and long words with a long tail of counts."""
    out = {}
    while len(out) < n:
        w = "".join(rng.choice("abcdeéñÿß÷z") for _ in range(rng.choice([6, 6, 7, 7, 8, 12, 70])))
        out[w] = int(5 * rng.paretovariate(0.5)) % 10**9 + 5
        for _ in range(rng.randrange(6)):
            k, c = rng.randrange(len(w)), rng.choice("abcdeéñÿß÷z")
            w = rng.choice([w[:k] + c + w[k + 1 :], w[:k] + c + w[k:], w[:k] + w[k + 1 :], "".join(rng.sample(w, len(w)))])
            if len(w) >= 6:
                out[w] = int(5 * rng.paretovariate(0.5)) % 10**9 + 5
    return out


def test_small_cells_and_tiles(spark):
    words = random_words(random.Random(1), 900)
    expect = slow(words)
    assert any(f for _, f, *_ in expect) and any(r not in (w, f) for w, f, r, *_ in expect)
    assert variants_of(spark, words, sample=300, cell=40, tile=16) == expect
    assert variants_of(spark, words, sample=1, cell=1, tile=7) == expect
    assert variants_of(spark, words) == expect


def test_long_chains_and_ties(spark):
    chain = {"aaaaaa" + "b" * k: 5 ** (k + 1) for k in range(12)}
    ties = {"zzzzzz": 5, "zzzzzy": 40, "zzzzzx": 40, "qzzzzzz": 40, "yyyyyy": 10, "yyyyyx": 49, "yyyyyyw": 50}
    got = variants_of(spark, chain | ties)
    assert got == slow(chain | ties)
    assert {r for w, _, r, *_ in got if w in chain} == {"aaaaaa" + "b" * 11}


def test_tile_borders_in_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    words = random_words(random.Random(2), 150)
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
        assert variants_of(spark, words, sample=100, cell=30) == slow(words)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_crc_and_letters():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abAZ éÀÿ×漢ſ1_-") for _ in range(rng.choice([0, 1, 40, 300]))) for _ in range(200)] + ["x" * 5000]
    data = [re.sub("[A-Z]", lambda m: m[0].lower(), t).encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(d) for d in data]))
    joined = np.frombuffer(b"".join(data), np.uint8)
    letters, starts, lengths, row, from_byte, n_bytes = spelling.one_byte_letters(joined, offsets)
    expect = [(i, w) for i, d in enumerate(data) for w in RUN.findall(d.decode())]
    assert [(r, bytes(letters[s : s + n]).decode("latin-1")) for r, s, n in zip(row, starts, lengths)] == expect
    state = np.array([zlib.crc32(f"{r}:".encode()) for r in row], np.uint32)
    assert spelling.crc_on(state, joined, from_byte, n_bytes).tolist() == [zlib.crc32(f"{r}:{w}".encode()) for r, w in expect]


def test_tree_finds_every_near_point():
    rng = np.random.default_rng(4)
    points = rng.integers(0, 3, (500, 8)).astype(np.int8)
    for tight in (True, False):
        tree = KdTree(points, 6, tight)
        query, leaf = tree.search(points, 1, 1)
        met = {(int(q), int(p)) for q, k in zip(query, leaf) for p in tree.order[tree.first[k] : tree.first[k + 1]]}
        d = points[None].astype(int) - points[:, None]
        near = (np.maximum(d, 0).sum(2) <= 1) & (np.maximum(-d, 0).sum(2) <= 1)
        assert {(int(a), int(b)) for a, b in np.argwhere(near)} <= met
        assert len(met) < 500 * 500 / 2
    alike = KdTree(np.zeros((50, 3), np.int8), 4, True)
    assert alike.n_leaves == 1


def test_odd_rows_and_empty_tables(spark, make_docs):
    rows = odd_rows(random.Random(5)) + [(i, "Straße STRASSE strasse ééééééé Éééééé") for i in range(1200)] + [(None, "Strasse")] * 7
    docs = make_docs(rows).withColumns({c: F.lit(1) for c in ("w", "n", "word", "form", "root", "near", "best")})
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling.digest(docs).collect()]
    assert sorted(got, key=lambda r: r[0]) == slow(slow_words(rows))
    assert spelling.digest(make_docs([])).collect() == []
    assert spelling.digest(make_docs([(1, None), (2, "")])).collect() == []

"""Packing against a plain count, exact shares, and the whole audit against a slow version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from terrace.llm import divergence, packed
from tests.llm.conftest import odd_rows

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def slow(rows, min_docs=3, top=200):
    """(lang, source, part, item, value, rank) rows from (text, lang, source) by the definition."""
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        V = len(kept)

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 1) // (total + V) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda x, y: (x - y) ** 2 // y
        for s in sources:
            pairs = [(b, sum(f(p[s][t], p[b][t]) for t in kept)) for b in sources if b != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, *x, k) for k, x in enumerate(found[:most], 1)]
    return sorted(out)


def audit(spark, rows, **more):
    docs = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string"
    ).withColumns({c: F.lit(7) for c in ("n", "term", "rows", "first", "id", "p", "absent", "item", "value", "rank")})
    return sorted(tuple(r) for r in divergence.digest(docs, **more).collect())


def test_packing_counts_every_length():
    rng = random.Random(1)
    words = ["".join(rng.choice("abéß漢z") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 40, 300]))) for _ in range(300)]
    rows = [[rng.choice(words) for _ in range(rng.randrange(40))] for _ in range(120)]
    rows.append(["x" * 8, "x" * 9, "x" * 16, "x" * 17, "x" * 8 + "y" * 8, "x" * 5000] * 2)
    texts = [" ".join(r).encode() for r in rows]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    starts, lengths, row = packed.spans(data != 32, offsets)
    # words of neighbouring rows touch in the bytes and must stay apart
    assert len(starts) == sum(map(len, rows))
    group = (row % 3).astype(np.uint32)
    runs = packed.count_runs(data, starts, lengths, group, row)
    got = {
        (int(g), w): (int(n), int(d))
        for g, w, n, d in zip(runs.group, packed.strings(data, runs.start, runs.length).to_pylist(), runs.count, runs.rows)
    }
    occurrences = Counter((i % 3, w) for i, r in enumerate(rows) for w in r)
    held = Counter((i % 3, w) for i, r in enumerate(rows) for w in set(r))
    assert len(runs.start) == len(got)
    assert got == {k: (n, held[k]) for k, n in occurrences.items()}


def test_radix_order_is_a_stable_sort():
    rng = np.random.default_rng(2)
    low, high = rng.integers(0, 2**63, 5000).astype(np.uint64) * 2, rng.integers(0, 4, 5000).astype(np.uint32) << 20
    assert (packed.radix_order([low, high]) == np.lexsort((low, high))).all()
    assert packed.radix_order([np.zeros(0, np.uint64)]).tolist() == []


def test_shares_stay_exact_at_any_count(spark):
    rng = random.Random(3)
    rows = [(n := rng.randrange(10 ** rng.randrange(1, 15)), n + rng.randrange(1, 10 ** rng.randrange(1, 15))) for _ in range(500)]
    df = spark.createDataFrame(rows, "n long, total long")
    for r in df.select("n", "total", divergence.share(F.col("n"), F.col("total")).alias("p")).collect():
        assert r.p == 1 + 10**9 * (r.n + 1) // r.total


def test_against_slow_version(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(260):
        lang, source = rng.choice(["en", "de", "fr"]), rng.choice(["hot", "hot", "hot", *(f"s{i}" for i in range(9))])
        words = [f"{rng.choice(['Wort', 'mot', 'wörd', 'x' * 20, 'y' * 12])}{'abcdefgh'[min(7, int(rng.paretovariate(0.8)))]}" for _ in range(rng.randrange(60))]
        rows.append((rng.choice([" ", ".", "1_"]).join(words), lang, source))
    rows += [(None, "en", "only nulls"), ("", "xx", "a"), ("", "xx", "b"), ("lone", None, None), ("Tie Tie tIe", "it", "p"), ("tie", "it", "q"), ("TIE", "it", "p")]
    rows += rows[:30]
    assert audit(spark, rows) == slow(rows)


def test_more_terms_than_ranks(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(700)]
    rows = [(" ".join(words[:500] + words[:40]), "en", "a")] * 3 + [(" ".join(words[300:]), "en", "b")] * 3
    got = audit(spark, rows)
    assert got == slow(rows)
    assert sum(r[2] == "term" and r[1] == "a" for r in got) == 200


def test_a_term_over_several_batches(spark):
    """Sums over rows that a batch border cuts, and a table of pairs emitted in parts."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rng = random.Random(6)
    rows = [(" ".join(rng.choice(["aa", "bb", "cc", "dd"]) for _ in range(9)), "en", f"s{i % 17}") for i in range(90)]
    pairs, divergence.PAIRS = divergence.PAIRS, 5
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        assert audit(spark, rows) == slow(rows)
    finally:
        divergence.PAIRS = pairs
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_odd_rows_and_empty_tables(spark):
    rows = [(t, "en", "s" if i != 3 else None) for i, t in odd_rows(random.Random(7))]
    assert audit(spark, rows) == slow(rows)
    assert audit(spark, []) == []
    assert audit(spark, [(None, None, None)]) == []

"""Repeated passages against brute force: every run of words in a dictionary."""

import random
import re

import numpy as np

from terrace.llm import suffix_dedup
from terrace.sources.tables import setting
from tests.llm.conftest import odd_rows, prose


def brute(rows, n):
    words = [(i, re.findall(r"[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    where = {}
    for i, w in words:
        for k in range(len(w) - n + 1):
            where.setdefault(tuple(w[k : k + n]), set()).add(i)
    covered = {}
    for i, w in words:
        for k in range(len(w) - n + 1):
            if len(where[tuple(w[k : k + n])]) > 1:
                covered.setdefault(i, set()).update(range(k, k + n))
    out = {}
    for i, held in covered.items():
        starts = sorted(x for x in held if x - 1 not in held)
        ends = sorted(x + 1 for x in held if x + 1 not in held)
        out[i] = (len(held), ",".join(f"{a}:{b}" for a, b in zip(starts, ends)))
    return out


def found(df, n, k):
    return {r.doc_id: (r.dup_words, r.spans) for r in suffix_dedup.digest(df, n, k).collect()}


def test_matches_brute_force(make_docs):
    rng = random.Random(3)
    passages = [prose(rng, rng.randrange(10, 40)) for _ in range(12)]
    rows = []
    for i in range(150):  # passages between other words, cut, edited, and whole copies
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(passages).split()
            a, b = sorted((rng.randrange(len(p)), rng.randrange(len(p) + 1)))
            parts += rng.choice([p, p[a:b], [*p[:a], "odd", *p[a + 1 :]]])
            parts += [f"own{rng.randrange(10**7)}" for _ in range(rng.randrange(0, 9))]
        rows.append((i, " ".join(parts)))
    rows += [(200 + i, rows[0][1]) for i in range(20)] + [(300, "x " * 100), (301, "y " + "x " * 60), (302, "z z " * 50)]
    for n, k in ((12, 4), (8, 8), (15, 1)):
        assert found(make_docs(rows), n, k) == brute(rows, n)


def test_three_variants_meet_at_one_place(make_docs):
    """The best partner of a suffix is next to it neither by the right nor by the left context."""
    mid = [f"m{i}" for i in range(6)]
    left, right = [f"l{i}" for i in range(9)], [f"r{i}" for i in range(9)]
    rows = []
    for i, (a, b) in enumerate([(9, 2), (2, 9), (5, 5), (5, 5), (0, 9), (9, 0)]):
        rows.append((i, " ".join([f"u{i}"] + left[9 - a :] + mid + right[:b] + [f"v{i}"])))
    assert found(make_docs(rows), 14, 3) == brute(rows, 14)


def test_partners_and_default_length(make_docs):
    rng = random.Random(4)
    p = prose(rng, 55, 10**6)
    rows = [(5, f"a b {p} c"), (9, f"{p}"), (7, "clean " + prose(rng, 80, 10**6)), (11, prose(rng, 70, 10**6) + "\n" + p)]
    got = {r.doc_id: (r.dup_words, r.spans) for r in suffix_dedup.digest(make_docs(rows)).collect()}
    assert got == {5: (55, "2:57"), 9: (55, "0:55"), 11: (55, "70:125")}
    # partners connect all documents that share the passage, and are never the document itself
    met = {r.doc_id: set(r.partners) for r in suffix_dedup.digest(make_docs(rows)).collect()}
    assert all(i not in p and p <= set(met) for i, p in met.items())
    group = {5}
    for _ in rows:
        group |= {i for i in met if met[i] & group} | set().union(*(met[i] for i in group))
    assert group == {5, 9, 11}


def groups(links):
    """Connected components of {document: partners}."""
    out = {i: {i} for i in links}
    for i, partners in links.items():
        for j in partners:
            both = out[i] | out[j]
            for k in both:
                out[k] = both
    return {frozenset(g) for g in out.values()}


def brute_groups(rows, n):
    where, links = {}, {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - n + 1):
            where.setdefault(tuple(w[k : k + n]), set()).add(i)
    for held in where.values():
        for i in held if len(held) > 1 else ():
            links.setdefault(i, set()).update(held - {i})
    return groups(links)


def test_partners_link_groups_of_copies(make_docs):
    rng = random.Random(6)
    rows = []
    for length in (55, 60, 70, 85):
        p = prose(rng, length, 10**6)
        x, y = (f"{prose(rng, 70, 10**6)} {p} {prose(rng, 70, 10**6)}" for _ in range(2))
        own = [f"{prose(rng, 30, 10**6)} {p} {prose(rng, 30, 10**6)}" for _ in range(2)]
        q = prose(rng, length, 10**6)
        a, b = (f"{prose(rng, 70, 10**6)} {q} {prose(rng, 70, 10**6)}" for _ in range(2))
        rows += enumerate([own[0], x, x, own[1], a, a, b, b], len(rows))
    got = suffix_dedup.digest(make_docs(rows)).collect()
    assert groups({r.doc_id: r.partners for r in got}) == brute_groups(rows, 50)
    assert {r.doc_id: (r.dup_words, r.spans) for r in got} == brute(rows, 50)


def test_touching_passages_keep_all_partners(make_docs):
    rng = random.Random(7)
    p, q, r = (prose(rng, 60, 10**6) for _ in range(3))
    own = [prose(rng, 40, 10**6) for _ in range(6)]
    rows = [(10, f"{own[0]} {p}"), (20, f"{p} {q}"), (30, f"{p} {own[1]}"), (5, f"{own[2]} {q} {own[3]}")]
    rows += [(40, f"{r} {own[4]}"), (50, f"{own[5]} {r}")]
    got = suffix_dedup.digest(make_docs(rows)).collect()
    assert groups({x.doc_id: x.partners for x in got}) == brute_groups(rows, 50) == {frozenset({5, 10, 20, 30}), frozenset({40, 50})}
    assert {x.doc_id: (x.dup_words, x.spans) for x in got} == brute(rows, 50)


def test_odd_rows_and_empty_table(make_docs):
    rows = odd_rows(random.Random(5))
    assert found(make_docs(rows), 50, 16) == {}  # repeated rows are one document
    assert found(make_docs(rows + [(20, rows[5][1])]), 50, 16) == {6: (30_000, "0:30000"), 20: (30_000, "0:30000")}
    assert found(make_docs([]), 50, 16) == {}


def test_rows_without_id_are_documents_of_their_own(make_docs):
    rng = random.Random(8)
    p, q = prose(rng, 60, 10**6), prose(rng, 60, 10**6)
    rows = [(None, f"a {p}"), (None, f"b c {p}"), (None, q), (None, q), (7, f"{q} d"), (None, prose(rng, 90, 10**6)), (None, None)]
    got = suffix_dedup.digest(make_docs(rows)).collect()
    assert sorted(r.spans for r in got if r.doc_id is None) == ["0:60", "0:60", "1:61", "2:62"]
    assert [(r.doc_id, r.spans, r.partners) for r in got if r.doc_id] == [(7, "0:60", [None])]


def brute_neighbours(parts):
    """What the compared partitions must say: matched suffixes with partners that hold the segment, and heads."""
    for rows, found in parts:
        rows = sorted(set(rows))
        docs, segs = {}, {}
        for h, s, d, a, b in rows:
            docs.setdefault((h, s), []).append(d)
            segs.setdefault(h, set()).add(s)
        matched = {r for r in rows if len(set(docs[r[:2]])) > 1}
        ends = {rows[0][:2], rows[-1][:2]} if rows else set()
        wanted = {k for k in docs if len(segs[k[0]]) > 1 or k in ends}
        assert sorted(f[1:6] for f in found if not f[0]) == sorted(matched)
        for f in found:
            if not f[0]:
                assert f[6] == f[7] != f[3] and f[6] in docs[f[1:3]]
        # neighbours connect all documents of a segment
        for k, own in docs.items():
            links = {}
            for f in found:
                if not f[0] and f[1:3] == k:
                    links.setdefault(f[3], set()).add(f[6])
            assert len(groups(links)) == (len(set(own)) > 1)
        heads = [f[1:] for f in found if f[0]]
        single = {r for r in rows if r[:2] in wanted and r not in matched}
        assert sorted(x[:5] for x in heads if x[5] == x[6]) == sorted(single)
        shared = sorted((*next(r for r in rows if r[:2] == k), min(docs[k]), max(docs[k])) for k in wanted if len(set(docs[k])) > 1)
        assert sorted(x for x in heads if x[5] != x[6]) == shared


def test_neighbours_in_any_cut_of_the_order():
    rng = random.Random(41)
    for trial in range(300):
        n = rng.choice([0, 1, 2, 40, 200])
        rows = sorted(
            (rng.randrange(rng.choice([1, 3, 30])), rng.randrange(rng.choice([1, 2, 5])), rng.randrange(rng.choice([1, 2, 9])), a := rng.randrange(4), a + 2)
            for _ in range(n)
        )
        seen, found, at = suffix_dedup.Neighbours(), [], 0
        kinds = (np.int64, np.int64, np.int64, np.int32, np.int32)
        while at < n:
            to = at + rng.choice([1, 2, 7, 50])
            found.append(seen.feed([np.array(x, k) for x, k in zip(zip(*rows[at:to]), kinds)]))
            at = to
        found.append(seen.finish())
        brute_neighbours([(rows, [r for f in found if f for r in zip(*(x.tolist() for x in f))])])


def test_suffixes_are_sorted_in_ranges_that_cut_a_passage(make_docs, spark, monkeypatch):
    """Many copies of one passage over more ranges than it needs: links and spans stay whole."""
    rng = random.Random(42)
    p = prose(rng, 90, 10**6)
    rows = [(i, p if i % 3 else f"{prose(rng, 20, 10**6)} {p} {prose(rng, 5, 10**6)} {p}") for i in range(120)]
    kept = suffix_dedup.suffixes(suffix_dedup.keyed(make_docs(rows))[0], 50, 16)
    plan = suffix_dedup.neighbours(kept)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h" in plan and "Sort [h" in plan
    monkeypatch.setattr(suffix_dedup, "COMPARED_ROWS", 5)
    with setting(spark, "spark.sql.shuffle.partitions", "31"), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        got = suffix_dedup.digest(make_docs(rows)).collect()
    assert {r.doc_id: (r.dup_words, r.spans) for r in got} == brute(rows, 50)
    assert groups({r.doc_id: r.partners for r in got}) == brute_groups(rows, 50) == {frozenset(range(120))}

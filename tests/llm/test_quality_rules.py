"""Repetition measures against brute force; verdicts on clear cases; the SQL on the smallest data."""

import random
import re

import pyarrow as pa
import pytest

from terrace.llm import quality_rules as q
from terrace.llm.words import chunks
from tests.llm.conftest import odd_rows, prose


def brute(text, least):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    n = len(w)

    def cover(m):
        places = {}
        for i in range(n - m + 1):
            places.setdefault(tuple(w[i : i + m]), []).append(i)
        return len({j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + m)})

    longest = 0
    while len({tuple(w[i : i + longest + 1]) for i in range(n - longest)}) < n - longest:
        longest += 1
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return [
        n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), cover(3), cover(least), longest,
    ]


@pytest.mark.parametrize("chunk", [1, 300, 1 << 20])
def test_measures_match_brute_force(chunk):
    rng = random.Random(6)
    texts = ["", None, " \n", "a", "a a", "a " * 40, "a b c " * 9 + "d", "é|é #\n\né|é #", "x\ny\nx\n \ny"]
    for _ in range(120):
        parts = (rng.choice("abcdé#") for _ in range(rng.randrange(90)))
        texts.append("".join(p + rng.choice([" ", "\n", "\t "]) for p in parts))
    got = []
    for at, to, data, offsets in chunks(pa.array(texts), chunk):
        found = q.measures(data, offsets, 5)
        got += [[int(found[c][i]) for c in q.COUNTS] for i in range(to - at)]
    assert got == [brute(t, 5) for t in texts]


def test_verdicts(make_docs):
    rng = random.Random(7)
    clean = prose(rng, 300, 10**6)
    half = prose(rng, 60, 10**6)
    filler = prose(rng, 300, 10**6)
    passage = prose(rng, 101, 10**6)
    rows = [
        (1, clean), (2, "spam " * 200), (3, f"{half} {half} {prose(rng, 130, 10**6)}"), (4, "short text"),
        (5, f"{passage} {filler} {filler[::-1]} {passage}"), (6, None),
    ]
    got = {r.doc_id: (r.base_failed, r.kept) for r in q.digest(make_docs(rows)).collect()}
    # 3: under half of the words repeat, but over 0.4 of them in long runs; 5: one repeat of 101 words
    assert got == {1: (False, True), 2: (True, False), 3: (False, False), 4: (True, False), 5: (False, False), 6: (True, False)}
    assert [r.doc_id for r in q.keep(make_docs(rows)).collect()] == [1]


def test_odd_rows_and_empty_table(make_docs):
    rows = odd_rows(random.Random(8))
    got = q.digest(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == sorted((str(i), len((t or "").split())) for i, t in rows)
    assert q.digest(make_docs([])).collect() == []
    clash = make_docs(rows).withColumnsRenamed({"lang": "kept", "source": "n_words"})
    assert q.keep(clash).columns == ["doc_id", "text", "kept", "n_words", "n_chars"]

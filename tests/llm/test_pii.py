"""Base spans against the plain patterns, CRF training and decoding, odd rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from terrace.llm import pii
from terrace.llm.words import chunks
from tests.llm.conftest import odd_rows


@pytest.fixture(scope="module")
def crf():
    return pii.Crf().fit()


def whole(text, crf):
    ((_, _, data, offsets),) = chunks(pa.array([text]), 1 << 30)
    (base,), (added,) = pii.find_all(data, offsets, crf)
    return pii.listed(base), [(pii.KINDS[k], text[a:b]) for k, a, b in added]


def brute_base(text):
    """Patterns over the whole text; checks written anew."""
    out = []
    for kind, pattern in pii.PATTERNS.items():
        for m in re.finditer(pattern.pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            twice = [2 * d - 9 * (2 * d > 9) if i % 2 else d for i, d in enumerate(digits[::-1])]
            good = {
                "email": True,
                "ip": kind == "ip" and max(map(int, m.group().split("."))) <= 255 if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and sum(twice) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_match_the_patterns_over_whole_texts(crf):
    rng = random.Random(17)
    pieces = ["+1 (212) 555-0100", "4111 1111 1111 1111", "4111-1111-1111-1112", "a.b@c-d.ef", "10.0.0.256", "192.168.0.1", "+", "(", "é", "1", " ", "\n", "\t", ".", "-", "@", "x9", "20", "%"]
    for _ in range(1500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert whole(text, crf)[0] == brute_base(text), repr(text)


def test_crf_adds_what_the_patterns_miss_and_leaves_numbers_alone(crf):
    assert whole("my phone is (333) 555-1234.", crf)[1] == [("phone", "(333) 555-1234")]
    assert whole("tel. 01 23 45 67 89, merci", crf)[1] == [("phone", "01 23 45 67 89")]
    assert whole("write bob@localhost now", crf)[1] == [("email", "bob@localhost")]
    for text in ("in 2020, 15 of 300 were 4.5", "version 4.0.1 of 2024-01-15 at 10:30", "order 99812 and 12 500 000", "page (3) - 4 of 20"):
        assert whole(text, crf) == ("", [])


def test_viterbi_finds_the_best_path(crf):
    runs = [pii.features(t.split()) for t in ("1 2", "(212) 555-0100 9", "+1 (212) 555-0100", "7")]
    for run, labels in zip(runs, crf.viterbi(runs)):
        move, emit = crf.step + crf.bar, crf.emit[np.array(run)].sum(axis=1)
        value = lambda p: sum(emit[i, x] for i, x in enumerate(p)) + sum(move[a, b] for a, b in zip([0, *p], [*p, 0]))
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(run)), key=value)
        assert value(labels) == pytest.approx(value(best))


def test_digest(make_docs, crf):
    text = "é mail a@b.co from 10.0.0.1 é card 4111111111111111 tel +49 30 901820 or (333) 555-1234"
    (row,) = pii.digest(make_docs([(1, text)])).collect()
    base = brute_base(text)
    assert tuple(row)[:6] == (1, 1, 1, 1, 1, hashlib.sha256(base.encode()).hexdigest())
    at = text.index("(333)")
    assert row.spans == f"{base},phone:{at}:{at + 14}"


def test_odd_rows_and_empty_table(make_docs):
    rows = odd_rows(random.Random(18)) + [(30, "1 " * 3000), (31, "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1")]
    got = pii.digest(make_docs(rows)).collect()
    assert len(got) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.n_card, r.base_sha256, r.spans) for r in got if r.doc_id not in (30, 31)} == {(0, empty, "")}
    assert [r.n_card for r in got if r.doc_id == 31] == [1]
    assert pii.digest(make_docs([])).collect() == []

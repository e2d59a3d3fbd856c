"""Permutation, law of rows, reruns, inverse."""

import random
import zlib

import numpy as np
import pytest

from terrace.llm import feistel, sharding
from tests.llm.conftest import odd_rows


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_permutation_is_a_bijection(n):
    keys = feistel.round_keys(5, n)
    image = feistel.permute(np.arange(n), n, keys)
    assert sorted(image) == list(range(n))
    assert (feistel.permute(image, n, keys, inverse=True) == np.arange(n)).all()


def test_permutation_mixes():
    image = feistel.permute(np.arange(100_000), 100_000, feistel.round_keys(1))
    assert abs(np.corrcoef(np.arange(100_000), image)[0, 1]) < 0.02
    shards = np.bincount(image[:2500] % 40, minlength=40)  # a run of rows spreads over all shards
    assert shards.min() > 30 and shards.max() < 100


def test_law_of_rows_slots_and_inverse(make_docs):
    rows = [(i, f"text {i % 50}") for i in range(1003)]
    got = sharding.digest(make_docs(rows)).collect()
    again = sharding.digest(make_docs(rows[::-1]).repartition(7)).collect()
    assert sorted(got) == sorted(again)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        text = f"text {r.doc_id % 50}"
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text.encode()), "rows", None)
        assert sharding.row_at(np.array([r.shard]), np.array([r.slot]), 1003, 40)[0] == r.doc_id
    assert sorted(slots) == list(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} == {25, 26}


def test_odd_rows_and_empty_table(make_docs):
    rows = odd_rows(random.Random(9))
    got = sharding.digest(make_docs(rows)).collect()
    assert len(got) == len(rows) and len({(r.shard, r.slot) for r in got}) == len(rows)
    assert {(r["size"], r.text_crc32) for r in got if r.doc_id in (1, 2)} == {(16, 0)}
    assert sharding.digest(make_docs([])).collect() == []
    clash = make_docs(rows).withColumnsRenamed({"lang": "shard", "source": "size"})
    assert sorted(sharding.assign(clash, 4).columns) == ["doc_id", "n_chars", "shard", "size", "slot", "text", "text_crc32"]

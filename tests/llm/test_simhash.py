"""SimHash groups against brute force: all pairs of fingerprints, plain union-find."""

import random
import re

import numpy as np
import pytest
import xxhash

from terrace.llm import simhash
from tests.llm.conftest import odd_rows, prose


def brute_print(text, shingle=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, radius=3):
    prints = [brute_print(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if (prints[i] ^ prints[j]).bit_count() <= radius or same_id:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    low = {}
    for x, (i, _) in zip(label, rows):
        if i is not None:
            low[x] = min(low.get(x, i), i)
    return sorted(((i, f"{p:016x}", low.get(x)) for (i, _), p, x in zip(rows, prints, label)), key=str)


def got_groups(df):
    return sorted(map(tuple, simhash.digest(df).collect()), key=str)


def near(rng, text, edits=1):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_matches_brute_force(make_docs):
    rng = random.Random(1)
    rows = [(i, prose(rng, 40)) for i in range(40)]
    base = [prose(rng, 900) for _ in range(4)]
    rows += [(100 + i, near(rng, base[i % 4])) for i in range(60)] + [(200 + i, base[0].upper()) for i in range(5)]
    rows += [(500, ""), (501, None), (502, "a"), (503, "A")]
    expected = brute_groups(rows)
    assert len({r[2] for r in expected}) < len(rows) - 20  # near copies did meet
    assert got_groups(make_docs(rows)) == expected


def test_odd_rows_and_empty_table(make_docs):
    rows = odd_rows(random.Random(2))
    assert got_groups(make_docs(rows)) == brute_groups(rows)
    assert got_groups(make_docs([])) == []


def test_keep_one_keeps_one_row_of_each_group(make_docs):
    rows = [(3, "a b c d"), (1, "A b c d"), (7, "x y z q"), (7, "x y z q"), (None, "a b c d"), (None, "k l m n"), (None, "k l m n")]
    kept = simhash.keep_one(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == [(1, "A b c d"), (7, "x y z q"), (None, "k l m n")]
    assert kept[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("n", [1, 2, 17, 63, 64, 65, 300])
@pytest.mark.parametrize("radius", [0, 1, 3, 4])
def test_bit_sliced_distances(n, radius):
    rng = np.random.default_rng(n * 10 + radius)
    a = rng.integers(1 << 63, size=n).astype(np.uint64)
    flips = np.zeros(n, np.uint64)
    for i in range(n):
        for b in rng.choice(64, rng.integers(0, 7), replace=False):
            flips[i] |= np.uint64(1) << np.uint64(b)
    found = simhash.linked_pairs(a, a ^ flips, list(range(64)), radius)
    assert found.tolist() == (np.bitwise_count(flips) <= radius).tolist()


def test_large_buckets_are_tiled_without_loss(spark):
    """300 fingerprints in a few dense balls, tiles of 16 rows: the same components as all pairs."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = set()
    while len(prints) < 300:
        x = rng.choice(centres)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    prints = sorted(prints)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    links = simhash.near_links(spark.createDataFrame(signed, "node long, fp long"), 3, tile=16)
    linked = dict(simhash.components(links, "test-cc").collect())
    low = {x: min(i for i, y in enumerate(label) if y == x) for x in set(label)}
    assert [linked.get(i, i) for i in range(len(prints))] == [low[x] for x in label]
    assert len(set(label)) < 60


@pytest.mark.parametrize("n", [17, 64, 65, 100, 128, 700])
def test_links_of_a_bucket_against_all_pairs(n):
    rng = np.random.default_rng(n)
    prints = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    for k in range(0, n - 3, 3):  # near ones within a block of lanes and across
        prints[n - 1 - k] = prints[k] ^ np.uint64(int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))))
    got = {(int(a), int(b)) for i, j in simhash.local_links(prints, list(range(64)), 3) for a, b in zip(i, j)}
    assert got == {(i, j) for i in range(n) for j in range(i + 1, n) if int(prints[i] ^ prints[j]).bit_count() <= 3}
    assert len(got) >= 3


def test_blocks_are_abandoned():
    """Random buckets, full and ragged: less than half of the planes are read; the masked-out parts none."""
    rng = np.random.default_rng(9)
    mask = simhash.block_masks(3)[0]
    bits = [b for b in range(64) if not mask >> b & 1]
    for n in (100, 128, 1000, 5000):
        prints = rng.integers(0, 2**63, n, dtype=np.uint64) & ~np.uint64(mask)
        tally, seen = [], 0
        for at in simhash.local_links(prints, bits, 3, tally):
            seen += len(at[0])
        assert seen == 0
        asked = sum(-(-n // 64) - i // 64 for i in range(n))  # blocks that hold a later fingerprint
        assert sum(tally) < 0.5 * len(bits) * asked
        pairs = []
        simhash.linked_pairs(prints[:-1], prints[1:], bits, 3, pairs)
        assert sum(pairs) < 0.55 * len(bits) * -(-(n - 1) // 64)


def test_a_dense_bucket_is_one_star():
    base = np.uint64(0x0123456789ABCDEF)
    near = [base] + [base ^ np.uint64(1 << b) for b in range(40)] + [base ^ np.uint64(3 << b) for b in range(0, 40, 2)]
    stars = simhash.local_stars(np.array(near, np.uint64), np.arange(len(near)) + 7, list(range(64)), 3)
    assert sorted(stars) == [(k + 7, 7) for k in range(1, len(near))]

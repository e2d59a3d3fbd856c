"""Exact counting of byte strings by length-bucketed packing (numpy, inside tasks).

Strings of up to 8 bytes become one uint64, up to 16 bytes two; they are
ordered by a least-significant-digit radix sort over 16-bit digits and counted
by runs. Longer strings go to buckets of their own by length (widths double),
each sorted by its bytes. A bucket's table takes at most twice its strings'
bytes. Strings hold no zero byte, so padding by zeros never joins two.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Sorted this many at a time at most.
ROWS = 1 << 22


class Runs(NamedTuple):
    """One entry for each distinct (group, string): where an occurrence starts, its length, group and counts."""

    start: np.ndarray
    length: np.ndarray
    group: np.ndarray
    count: np.ndarray
    rows: np.ndarray


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order by ``keys`` (unsigned, least significant first), 16 bits a pass; constant digits cost no pass."""
    order = None
    for key in keys:
        for shift in range(0, key.dtype.itemsize * 8, 16):
            digit = ((key >> key.dtype.type(shift)) & key.dtype.type(0xFFFF)).astype(np.uint16)
            if len(digit) and (digit == digit[0]).all():
                continue
            if order is None:
                order = np.argsort(digit, kind="stable")
            else:
                order = order[np.argsort(digit[order], kind="stable")]
    return np.arange(len(keys[0])) if order is None else order


def packed_word(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first 8 bytes of each string as one uint64, big end first, zeros behind shorter ones.

    ``data`` has 8 bytes or more behind the last start.
    """
    eight = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))[starts].astype(np.uint64)
    spare = np.clip(8 - lengths, 0, 8).astype(np.uint64) * np.uint64(8)
    keep = np.where(spare == 64, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) << (spare & np.uint64(63)))
    return eight & keep


def byte_table(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The strings as fixed-width byte strings."""
    table = np.zeros((len(starts), width), np.uint8)
    at = np.repeat(np.cumsum(lengths) - lengths, lengths)
    within = np.arange(int(lengths.sum())) - at
    table[np.repeat(np.arange(len(starts)), lengths), within] = data[np.repeat(starts, lengths) + within]
    return table.reshape(-1).view(f"S{width}")


def count_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, group: np.ndarray, row: np.ndarray) -> Runs:
    """Occurrences of each (group, string), and the number of rows that hold it.

    ``row`` never falls from one occurrence to the next; ``group`` is unsigned.
    """
    data = np.concatenate([data, np.zeros(16, np.uint8)])
    widths = [(0, 8), (8, 16)]
    while len(lengths) and widths[-1][1] < lengths.max():
        widths.append((widths[-1][1], widths[-1][1] * 2))
    found = []
    for over, width in widths:
        own = np.flatnonzero((lengths > over) & (lengths <= width))
        for at in range(0, len(own), ROWS):
            found.append(_bucket(data, own[at : at + ROWS], width, starts, lengths, group, row))
    empty = np.zeros(0, np.int64)
    return Runs(*(np.concatenate(x) for x in zip(*found))) if found else Runs(empty, empty, empty, empty, empty)


def _bucket(data, own, width, starts, lengths, group, row) -> Runs:
    s, n, g, r = starts[own], lengths[own], group[own], row[own]
    if width <= 16:
        words = [packed_word(data, s, n)]
        if width == 16:
            words = [packed_word(data, s + 8, n - 8), *words]
    else:
        text = byte_table(data, s, n, width)
        ranked = np.argsort(text, kind="stable")
        new = np.append(True, text[ranked][1:] != text[ranked][:-1])
        words = [np.empty(len(own), np.uint64)]
        words[0][ranked] = np.cumsum(new, dtype=np.uint64)
    order = radix_order([*words, g])
    s, n, g, r = s[order], n[order], g[order], r[order]
    new = np.ones(len(own), bool)
    new[1:] = g[1:] != g[:-1]
    for w in words:
        w = w[order]
        new[1:] |= w[1:] != w[:-1]
    first = np.flatnonzero(new)
    new[1:] |= r[1:] != r[:-1]
    return Runs(s[first], n[first], g[first], np.diff(np.append(first, len(own))), np.add.reduceat(new.astype(np.int64), first))


def strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The byte strings as an Arrow string column."""
    ends = np.append(0, np.cumsum(lengths)).astype(np.int64)
    from_byte = np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[from_byte]))
    ).cast(pa.string())


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)


def spans(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, row) of the maximal runs of ``solid`` bytes that lie in one row."""
    edge = np.zeros(len(solid) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros_like(solid), np.zeros_like(solid)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends - starts, np.searchsorted(offsets, starts, "right") - 1

"""Vectorised word splitting and hashing of Arrow string columns (numpy, inside tasks).

A word is a run of code points other than space and U+0009..U+000D. These are
single bytes in UTF-8, so everything works on the column's bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U = np.uint64
#: Fixed pseudo-random constants of the hashes.
_BASE = U(0x9E3779B97F4A7C15)
_STEP = U(0xD1342543DE82EF95)
CHUNK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def blank_bytes() -> np.ndarray:
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    return blank


def byte_codes(lower: bool) -> np.ndarray:
    """A random 64-bit code per byte, zero for blanks; with ``lower``, A-Z count as a-z."""
    with np.errstate(over="ignore"):
        codes = mix((np.arange(256, dtype=U) + U(1)) * _BASE)
    if lower:
        codes[65:91] = codes[97:123]
    codes[blank_bytes()] = 0
    return codes


class Words:
    """The words of a run of texts: byte bounds, the row of each, and 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashes: bool = True):
        self.data, self.offsets = data, offsets
        solid = ~blank_bytes()[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.empty_like(solid)
        before[:1] = False
        before[1:] = solid[:-1]
        self.starts = np.flatnonzero(solid & (~before | edge[:-1]))
        after = np.empty_like(solid)
        after[-1:] = False
        after[:-1] = solid[1:]
        self.ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)  # of each row, and the end
        self.n_words = np.diff(self.first)
        if hashes:
            self.hash = self._hash(lower)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_words)), self.n_words)

    def _hash(self, lower: bool) -> np.ndarray:
        out = np.zeros(len(self.starts), U)
        codes, at = byte_codes(lower), 0
        with np.errstate(over="ignore"):
            while at < len(self.starts):
                to = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + CHUNK_BYTES, "right")))
                lo, hi = self.starts[at], self.ends[to - 1]
                starts = self.starts[at:to] - lo
                spans = np.diff(np.append(starts, hi - lo))
                place = np.arange(hi - lo) - np.repeat(starts, spans)
                power = np.cumprod(np.full(int(spans.max()) + 1, _STEP, U))
                out[at:to] = np.add.reduceat(codes[self.data[lo:hi]] * power[place], starts)
                at = to
            return mix(out)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``; at a partition's end the worker gives freed memory back to the system.

    Workers live on between stages; what their allocators keep would count
    against the executor beside the next stage's needs.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return tidied


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def lean(docs: DataFrame, rows: int = 1000) -> DataFrame:
    """``docs``, in a session whose Arrow batches hold at most ``rows`` rows.

    A batch of whole texts is in memory several times (in the executor, on its
    way, in the worker); the default of 10,000 rows is meant for numbers.
    """
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(BATCH_ROWS, "10000")) <= rows:
        conf.set(BATCH_ROWS, str(rows))
    return docs


def pick_text(docs: DataFrame, carry: list[str], *more: Column) -> tuple[DataFrame, int]:
    """``carry``, the text if that lacks it, and ``more``; and where the text is. Texts go to Python once."""
    docs = lean(docs)
    if "text" in carry and docs.schema["text"].dataType.simpleString() == "string":
        return docs.select(*carry, *more), carry.index("text")
    text = F.col("text").cast("string").alias("__text")
    return docs.select(*carry, *more, text), len(carry) + len(more)


def kinds_of(df: DataFrame, names: list[str]) -> list[str]:
    """DDL of the columns ``names``."""
    return [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names]


def chunks(texts: pa.Array, max_bytes: int = 4 << 20):
    """(first row, row after the last, data, offsets): runs of rows of about ``max_bytes``; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + max_bytes, "right")) - 1)
        yield at, to, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def run_hash(items: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` items (length ``len(items) - n + 1``), by doubling."""

    def joined(left, left_n, right, factor):
        tail = right[left_n:]
        return left[: len(tail)] * factor + tail

    with np.errstate(over="ignore"):
        total, done, part, width, factor = None, 0, items, 1, _STEP
        while done < n:
            if n & width:
                total = part if total is None else joined(total, done, part, factor)
                done += width
            part = joined(part, width, part, factor)
            width, factor = width * 2, factor * factor
        return mix(total)


def run_min(items: np.ndarray, n: int) -> np.ndarray:
    """Least of each run of ``n`` items."""
    part, width = items, 1
    while width * 2 <= n:
        part = np.minimum(part[:-width], part[width:]) if len(part) > width else part[:0]
        width *= 2
    rest = n - width
    if rest == 0 or len(part) <= rest:
        return part[: max(0, len(items) - n + 1)]
    return np.minimum(part[:-rest], part[rest:])

"""Passages that repeat across documents, by sparse suffix arrays.

Of every text's word suffixes only those at minimiser positions are kept: in
each run of ``MIN_WORDS`` words the suffix whose first ``KEY_WORDS`` words hash
lowest (leftmost if tied). Equal passages of ``MIN_WORDS`` words choose the
same place in both texts, so no repeat is missed, and about one suffix in
eighteen is kept. A kept suffix owns the runs that chose it; its segment is
the words of all of them.

The kept suffixes are sorted: by their first words, then by their segment, then
by document, with hashes in place of the words, so that suffixes that begin alike
are neighbours. Ranges are cut anywhere, also within the suffixes of one passage.

1. Every suffix is compared with its neighbours. One whose whole segment its neighbour
   has in another document matches to both ends of the segment. A suffix whose
   neighbours begin with other words is dropped. What a partition cannot see, the
   other side of its two ends, comes from the ``heads``: suffixes at the ends, and one
   for each segment among several that begin alike.
2. Where segments that begin alike differ, matches are extended to the left and
   right. Comparing with the next suffix only would miss a match
   once three variants meet, so each extension of ``MIN_WORDS`` words (l words left, the rest right) is
   compared with all others that reach as far, by the hash of that stretch:
   equal stretches meet in an aggregate. One suffix stands for all copies of its
   segment here, so groups of copies are not expanded; it links them to the others.
3. Matched stretches of a document are united into spans, which keep every partner
   of their stretches.

Hashes have 64 bits. A task holds a document's own suffixes of one segment at most, rows of
a group are never held together. Texts are read twice: for the suffixes, and
for the extensions.

Defined cases: null, empty and short texts (under ``MIN_WORDS`` words) have no
repeats; rows that share a ``doc_id`` count as one document, so repeated rows
alone are no repeat across documents; every row without a ``doc_id`` is a document
of its own, with a row of its own in the result, and null as a partner; a passage that recurs in
one document only is not reported; an empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.tables import row_numbers, stored
from terrace.llm.words import Words, chunks, lean, mix, run_hash, run_min, tidy

U = np.uint64
MIN_WORDS, KEY_WORDS = 50, 16
CHUNK = 2 << 20
COMPARED_ROWS = 1 << 16
NO_ID = -(2**63)
_STEP = 0xA0761D6478BD642F | 1


def stretch_hashes(tokens: np.ndarray):
    """A function from (start, end) word positions to the 64-bit hash of that stretch."""
    n = len(tokens)
    with np.errstate(over="ignore"):
        power = np.ones(n + 1, U)
        power[1:] = np.cumprod(np.full(n, U(_STEP)))
        back = np.ones(n + 1, U)
        back[1:] = np.cumprod(np.full(n, U(pow(_STEP, -1, 1 << 64))))
        total = np.zeros(n + 1, U)
        total[1:] = np.cumsum(tokens * power[:-1])

    def of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((total[end] - total[start]) * back[start] + (end - start).astype(U) * U(0x9E3779B97F4A7C15))

    return of


def minimisers(words: Words, min_words: int, key_words: int) -> dict[str, np.ndarray]:
    """Kept suffixes: row, place p, first and last run (a, b) that chose it, key and segment hash."""
    n = len(words.starts)
    start_of_row, end_of_row = words.first[:-1], words.first[1:]
    row = words.rows()
    runs = np.flatnonzero(np.arange(n) + min_words <= end_of_row[row]) if n else np.zeros(0, np.int64)
    if not len(runs):
        none = np.zeros(0, np.int64)
        return {"row": none, "p": none, "a": none, "b": none, "key": none, "seg": none}
    key = run_hash(words.hash, key_words)
    packed = (key & U(0xFFFFFFFF00000000)) | np.arange(len(key), dtype=U)
    place = (run_min(packed, min_words - key_words + 1)[runs] & U(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(runs), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[runs][1:] != row[runs][:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(runs)) - 1
    a, b, p = runs[heads], runs[tails], place[heads]
    seg = stretch_hashes(words.hash)(a, b + min_words)
    base = start_of_row[row[a]]
    return {
        "row": row[a],
        "p": p - base,
        "a": a - base,
        "b": b - base,
        "key": key[p].view(np.int64),
        "seg": seg.view(np.int64),
    }


def suffixes(docs: DataFrame, min_words: int, key_words: int) -> DataFrame:
    """(h, seg, doc, a, b) of every kept suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, to, data, offsets in chunks(batch.column(1), CHUNK):
                found = minimisers(Words(data, offsets), min_words, key_words)
                yield pa.record_batch(
                    [
                        pa.array(found["key"]),
                        pa.array(found["seg"]),
                        pa.array(ids[at:to][found["row"]]),
                        pa.array(found["a"].astype(np.int32)),
                        pa.array(found["b"].astype(np.int32)),
                    ],
                    names=["h", "seg", "doc", "a", "b"],
                )

    return docs.select("doc", "text").mapInArrow(tidy(run), "h long, seg long, doc long, a int, b int")


class Neighbours:
    """A sorted partition's suffixes, each compared with those next to it; fed in runs of rows of any length.

    ``feed`` takes and ``finish`` ends; both give (head, h, seg, doc, a, b, lo, hi):
    a suffix and the neighbouring document with the same segment (``lo`` and ``hi``), or a
    head: a suffix that stands for its segment (with the first and last document that
    has it here), or each suffix of a segment that one document alone has here. Segments have heads
    if others begin alike, or if they lie at an end of the partition.
    Between runs only the last document's suffixes of the last segment are held.
    """

    def __init__(self):
        self.held: list[np.ndarray] | None = None
        self.before = None  # the document before the held one, with the same segment
        self.head = None  # that segment's first (doc, a, b), if it is no longer held
        self.h_before = None  # first words of the segment before
        self.at_start = True

    def feed(self, rows: list[np.ndarray]) -> list[np.ndarray] | None:
        return self._compare(rows, False)

    def finish(self) -> list[np.ndarray] | None:
        return self._compare(None, True)

    def _compare(self, rows, final: bool) -> list[np.ndarray] | None:
        if self.held is not None:
            rows = self.held if rows is None else [np.concatenate(x) for x in zip(self.held, rows)]
        if rows is None or not len(rows[0]):
            return None
        again = np.zeros(len(rows[0]), bool)  # repeated rows of one document
        again[1:] = np.logical_and.reduce([x[1:] == x[:-1] for x in rows])
        h, seg, doc, a, b = rows = [x[~again] for x in rows]
        new_seg, new_doc = np.ones(len(h), bool), np.ones(len(h), bool)
        new_seg[1:] = (h[1:] != h[:-1]) | (seg[1:] != seg[:-1])
        new_doc[1:] = new_seg[1:] | (doc[1:] != doc[:-1])
        run, group = np.cumsum(new_seg) - 1, np.cumsum(new_doc) - 1
        first, group_first = np.flatnonzero(new_seg), np.flatnonzero(new_doc)
        n_runs, n_groups = len(first), len(group_first)
        went_on = self.before is not None  # the first run began in an earlier one
        # documents: the one before, or else the one after, with the same segment
        group_doc, group_run = doc[group_first], run[group_first]
        joined = group_run[1:] == group_run[:-1]
        has_before, has_after = np.append(went_on, joined), np.append(joined, False)
        near = np.append(group_doc[1:], 0)
        near[1:][joined] = group_doc[:-1][joined]
        if went_on:
            near[0] = self.before
        closed = np.ones(n_groups, bool)
        closed[-1] = final
        met = (closed & (has_before | has_after))[group]
        out = [[np.zeros(int(met.sum()), bool), *(x[met] for x in rows), near[group][met], near[group][met]]]
        # segments whose last document is known
        run_h, last_group = h[first], np.searchsorted(group_run, np.arange(n_runs), "right") - 1
        alike = run_h[1:] == run_h[:-1]
        wanted = np.append(self.h_before is not None and run_h[0] == self.h_before, alike) | np.append(alike, False)
        wanted[0] |= self.at_start
        wanted[-1] = final
        alone = last_group == np.searchsorted(group_run, np.arange(n_runs), "left")
        alone[0] &= not went_on
        every = (wanted & alone)[run]
        out.append([np.ones(int(every.sum()), bool), *(x[every] for x in rows), doc[every], doc[every]])
        many = np.flatnonzero(wanted & ~alone)
        heads = [x[first[many]] for x in (doc, a, b)]
        if went_on and len(many) and many[0] == 0:
            for x, value in zip(heads, self.head):
                x[0] = value
        out.append([np.ones(len(many), bool), run_h[many], seg[first[many]], *heads, heads[0], group_doc[last_group[many]]])
        # what the next run of rows must know
        if n_runs > 1:
            self.h_before, self.at_start = run_h[-2], False
        if not (went_on and n_runs == 1):
            self.head = tuple(x[first[-1]] for x in (doc, a, b))
        if n_groups > 1:
            self.before = group_doc[-2] if joined[-1] else None
        self.held = [x[group_first[-1] :] for x in rows]
        return [np.concatenate(x) for x in zip(*out)]


def neighbours(kept: DataFrame) -> DataFrame:
    """(head, h, seg, doc, a, b, lo, hi): the sorted suffixes ``kept`` that a neighbour matches, and the heads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["head", "h", "seg", "doc", "a", "b", "lo", "hi"]
        seen, some, n = Neighbours(), [], 0
        for batch in batches:
            some.append([c.to_numpy() for c in batch.columns])
            n += batch.num_rows
            if n >= COMPARED_ROWS:
                found = seen.feed([np.concatenate(x) for x in zip(*some)])
                some, n = [], 0
                if found:
                    yield pa.record_batch([pa.array(x) for x in found], names=names)
        last = [seen.feed([np.concatenate(x) for x in zip(*some)])] if some else []
        for found in (*last, seen.finish()):
            if found:
                yield pa.record_batch([pa.array(x) for x in found], names=names)

    order = ["h", "seg", "doc", "a", "b"]
    return (
        kept.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(tidy(run), "head boolean, h long, seg long, doc long, a int, b int, lo long, hi long")
    )


def extensions(docs: DataFrame, todo: DataFrame, min_words: int) -> DataFrame:
    """(doc, s, g, lo, hi): every run of ``min_words`` words that the suffixes of ``todo`` own."""
    per_doc = todo.groupBy("doc").agg(F.collect_list(F.struct("a", "b", "lo", "hi")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, to, data, offsets in chunks(batch.column(1), CHUNK):
                words = Words(data, offsets)
                own = batch.column(2).slice(at, to - at)
                flat, n_own = own.flatten(), np.diff(own.offsets.to_numpy())
                a, b, lo, hi = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                row = np.repeat(np.arange(to - at), n_own)
                # a repeated doc_id may bring runs that this row's text does not have
                fits = b + min_words <= words.n_words[row]
                a, b, lo, hi, row = (x[fits] for x in (a, b, lo, hi, row))
                n_runs = (b - a + 1).astype(np.int64)
                which = np.repeat(np.arange(len(a)), n_runs)
                s = a[which] + np.arange(len(which)) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs)
                g = s + words.first[:-1][row[which]]
                hashed = run_hash(words.hash, min_words)[g] if len(g) else np.zeros(0, U)
                yield pa.record_batch(
                    [
                        pa.array(ids[at:to][row[which]]),
                        pa.array(s.astype(np.int32)),
                        pa.array(hashed.view(np.int64)),
                        pa.array(lo[which]),
                        pa.array(hi[which]),
                    ],
                    names=["doc", "s", "g", "lo", "hi"],
                )

    return (
        docs.join(per_doc, "doc")
        .select("doc", "text", "own")
        .mapInArrow(tidy(run), "doc long, s int, g long, lo long, hi long")
    )


def keyed(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc, text), and how many rows lack an id: those are numbered from ``NO_ID`` and kept, for both readings."""
    texts = lean(docs).select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    with_id, without = texts.where("doc is not null"), texts.where("doc is null and text is not null").select("text")
    if without.isEmpty():
        return with_id, 0
    numbered, total = row_numbers(without, [F.xxhash64("text")], "suffix-no-id")
    return with_id.union(numbered.select((F.col("__row") + F.lit(NO_ID)).alias("doc"), "text")), total


def matches(docs: DataFrame, min_words: int = MIN_WORDS, key_words: int = KEY_WORDS) -> DataFrame:
    """(doc, doc_id, start, end, partner): stretches of words that another document has too; they may overlap.

    ``doc`` is the ``doc_id``, or a number for a row that has none.
    ``partner`` is another document with the stretch: a neighbour in the order of the
    suffixes, or the first or last one that has it. Partners connect all
    documents that share a passage; pairs between copies are not spelt out.
    """
    texts, n_no_id = keyed(docs)
    known = F.lit(NO_ID + n_no_id)
    kept = stored(suffixes(texts, min_words, key_words), "suffixes")
    compared = stored(neighbours(kept), "suffix-order")
    end = (F.col("b") + min_words).alias("e")
    same = compared.where("not head").select("doc", "a", end, "lo", "hi")
    # segments across the ends of partitions, and beside others that begin alike
    heads = compared.where("head")
    classes = stored(
        heads.groupBy("h", "seg").agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min(F.struct("doc", "a", "b")).alias("one")
        ),
        "suffix-classes",
    )
    many = classes.where("lo < hi")
    own = heads.select("h", "seg", "doc", "a", "b")
    cut = own.join(many.drop("one"), ["h", "seg"]).select("doc", "a", end, "lo", "hi")
    # stored, so that first words with very many segments are split by the skew-join rule
    mixed = stored(
        classes.groupBy("h")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), (F.min("seg") != F.max("seg")).alias("mixed"))
        .where("mixed and lo < hi")
        .select("h"),
        "suffix-mixed",
    )
    alone = own.join(classes.where("lo = hi").select("h", "seg"), ["h", "seg"], "left_semi").join(mixed, "h", "left_semi")
    todo = alone.select("doc", "a", "b", F.col("doc").alias("lo"), F.col("doc").alias("hi")).union(
        many.join(mixed, "h", "left_semi").select("one.doc", "one.a", "one.b", "lo", "hi")
    )
    runs = stored(extensions(texts, todo, min_words), "suffix-runs")
    # classes with the same first and last document are linked already
    met = stored(
        runs.groupBy("g")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("lo").alias("lo2"), F.min("hi").alias("hi2"))
        .where("lo < hi and (lo < lo2 or hi2 < hi)")
        .select("g", "lo", "hi"),
        "suffix-met",
    )
    # the one suffix of a class with copies links all of them
    part = (
        runs.select("g", "doc", "s")
        .join(met, "g")
        .select("doc", F.col("s").alias("a"), (F.col("s") + min_words).alias("e"), "lo", "hi")
    )
    every = same.union(cut).union(part)
    return every.select(
        "doc",
        F.when(F.col("doc") >= known, F.col("doc")).alias("doc_id"),
        F.col("a").cast("long").alias("start"),
        F.col("e").cast("long").alias("end"),
        F.when(F.col("doc") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("partner"),
    ).withColumn("partner", F.when(F.col("partner") >= known, F.col("partner")))


def spans(found: DataFrame) -> DataFrame:
    """(doc, doc_id, start, end, partners): the union of ``found`` stretches, one row a span (word positions).

    ``partners`` are all of the span's: a span may hold passages of several groups of documents.
    """
    order = Window.partitionBy("doc").orderBy("start", "end", "partner")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    cut = found.withColumn("top", F.max("end").over(before)).withColumn(
        "new", F.when(F.col("start") <= F.col("top"), 0).otherwise(1)
    )
    numbered = cut.withColumn(
        "span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return (
        numbered.groupBy("doc", "span")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.collect_set(F.struct("partner")).alias("partners"),
        )
        .drop("span")
    )


def digest(docs: DataFrame, min_words: int = MIN_WORDS, key_words: int = KEY_WORDS) -> DataFrame:
    """One row per document with a passage that another document has: doc_id, words covered, spans, partners."""
    one = F.struct("start", "end", "partners")
    listed = (
        spans(matches(docs, min_words, key_words))
        .groupBy("doc")
        .agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(one)).alias("s"))
    )
    return listed.select(
        "doc_id",
        F.aggregate("s", F.lit(0).cast("long"), lambda t, x: t + x["end"] - x["start"]).alias("dup_words"),
        F.array_join(
            F.transform("s", lambda x: F.concat(x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ","
        ).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("s", lambda x: x["partners"]["partner"])))).alias("partners"),
    )

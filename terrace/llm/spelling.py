"""Spelling variant grouping: words one edit apart, found by k-d trees over letter counts.

One edit moves a word's vector of letter counts by one step up, one step down,
or one of each (L1 distance at most two). For each word length a k-d tree over a
bounded sample of the words cuts space into cells; every word is put in the
cell it lies in, and asked, by box pruning, of the cells that one step up and
one down can reach among its own length, and one step up among the next
length. Within a cell a k-d tree of its own words prunes again, a 64-bit
signature of the counts drops most of what is left, and the letters' order
decides. Cells of more than ``TILE`` words become tiles: words are dealt by
hash, and askers go to every tile, so no cell is capped and none is held whole.

Words are counted by packing (``packed``) with one byte a letter, as all letters
lie below U+0100, and go through Spark in that form.

A word's form is its near word of largest count (ties: the first in code-point
order), if that count is at least ``RATIO`` times its own. Forms are followed by
pointer doubling; counts grow at each step, so there is always a last one.

Defined cases: null, empty and letterless texts have no words; a null doc_id
hashes as an empty id; rows are read one by one, so repeated rows count each;
an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.kdtree import KdTree
from terrace.llm.packed import count_runs, lowered, spans
from terrace.llm.tables import stored
from terrace.llm.words import chunks, lean, tidy

MIN_LENGTH, MIN_COUNT, RATIO, SLIP = 6, 5, 5, 199
DIMS = 32
#: Words whose vectors make the trees of cells, and what a cell holds if the sample is fair.
SAMPLE, CELL, TILE = 1 << 16, 2048, 1 << 15
LEAF = 32
#: Candidate pairs compared at a time.
PAIRS = 1 << 21
CHUNK = 8 << 20


def one_byte_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(letters, starts, lengths, row, utf8 starts, utf8 lengths) of the runs of A-Z, a-z and U+00C0..U+00FF.

    ``letters`` is the text with each of those as one byte (its code point).
    """
    lead = np.zeros(len(data), bool)  # C3 before 80..BF: U+00C0..U+00FF
    lead[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    tail = np.zeros(len(data), bool)
    tail[1:] = lead[:-1]
    solid = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | lead | tail
    starts, lengths, row = spans(solid, offsets)
    before = np.append(0, np.cumsum(~lead))  # letters start where their lead byte is
    letters = np.where(tail, data + np.uint8(0x40), data)[~lead]
    return letters, before[starts], before[starts + lengths] - before[starts], row, starts, lengths


def crc_table() -> np.ndarray:
    """The byte table of CRC-32 (reflected polynomial EDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte string, going on from ``state`` (the CRC of what stands before it)."""
    table, crc = crc_table(), state.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(lengths > 64):  # rare, and long
        crc[k] = zlib.crc32(data[starts[k] : starts[k] + lengths[k]].tobytes(), int(state[k])) ^ 0xFFFFFFFF
    at, k = np.flatnonzero(lengths <= 64), 0
    while len(at := at[lengths[at] > k]):
        now = crc[at]
        crc[at] = table[(now ^ data[starts[at] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
        k += 1
    return crc ^ np.uint32(0xFFFFFFFF)


def slipped(data: np.ndarray, offsets: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, ...]:
    """(letters, starts, lengths, row) of the words, every ``SLIP``-th one (by its CRC) without one letter."""
    letters, starts, lengths, row, from_byte, n_bytes = one_byte_letters(data, offsets)
    crc = crc_on(prefix[row], data, from_byte, n_bytes).astype(np.int64)
    hit = np.flatnonzero(crc % SLIP == 0)
    keep = np.ones(len(letters), bool)
    keep[starts[hit] + crc[hit] % lengths[hit]] = False
    moved = np.append(0, np.cumsum(keep))
    ends = moved[starts + lengths]
    return letters[keep], moved[starts], ends - moved[starts], row


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(w, n): words in one-byte letters and how often they occur; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
            for at, to, data, offsets in chunks(batch.column(1), CHUNK):
                letters, starts, lengths, row = slipped(lowered(data), offsets, prefix[at:to])
                own = np.flatnonzero(lengths >= min_length)
                runs = count_runs(letters, starts[own], lengths[own], np.zeros(len(own), np.uint16), row[own])
                yield pa.record_batch([one_byte_column(letters, runs.start, runs.length), pa.array(runs.count, pa.int64())], names=["w", "n"])

    read = lean(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("string"))
    found = read.mapInArrow(tidy(run), "w binary, n long")
    return stored(found.groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "spelling-words")


def one_byte_column(letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
    at = np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(letters[at]))])


class WordList:
    """Words in one-byte letters: their bytes, bounds, letter counts and signatures."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        self.bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.lengths = np.diff(self.bounds)

    def __len__(self) -> int:
        return len(self.lengths)

    def counts(self) -> np.ndarray:
        """(words, DIMS): a to z, other letters folded into the rest. Equal steps stay equal or vanish when folded or clipped."""
        fold = np.arange(256) % (DIMS - 26) + 26
        fold[97:123] = np.arange(26)
        held = fold[self.data[self.bounds[0] : self.bounds[-1]]]
        cell = np.repeat(np.arange(len(self)), self.lengths) * DIMS + held
        return np.minimum(np.bincount(cell, minlength=len(self) * DIMS), 127).reshape(-1, DIMS).astype(np.int8)

    def letters(self, which: np.ndarray, length: int) -> np.ndarray:
        """(words, length) bytes of words of one length."""
        return self.data[self.bounds[which][:, None] + np.arange(length)]


def signature(counts: np.ndarray) -> np.ndarray:
    """64 bits: counts of at least one and at least two. A step in one count changes one bit at most."""
    flags = np.concatenate([counts >= 1, counts >= 2], axis=1)
    return np.packbits(flags, axis=1, bitorder="little").view(np.uint64).ravel()


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_deleted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether ``long`` without one letter is ``short``: what differs from the left lies behind what differs from the right."""
    length = short.shape[1]
    left, right = short != long[:, :-1], short != long[:, 1:]
    first = np.where(left.any(axis=1), left.argmax(axis=1), length)
    last = np.where(right.any(axis=1), length - 1 - right[:, ::-1].argmax(axis=1), -1)
    return last < first


class Cell:
    """The words of one tile of a cell, ready to be asked."""

    def __init__(self, words: pa.Array, n: np.ndarray):
        self.words, self.column, self.n = WordList(words), words, n
        counts = self.words.counts()
        self.tree = KdTree(counts, LEAF, tight=True)
        self.order = self.tree.order
        self.signature = signature(counts)[self.order]

    def near(self, asked: WordList, same_length: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asker, word) pairs one edit apart; askers have the words' length or one letter less."""
        counts = asked.counts()
        marks, length = signature(counts), int(asked.lengths[0])
        query, leaf = self.tree.search(counts, 1, 1 if same_length else 0)
        sizes = np.diff(self.tree.first)[leaf]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(query):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
            some = sizes[at:to]
            place = np.arange(int(some.sum())) - np.repeat(np.cumsum(some) - some, some) + np.repeat(self.tree.first[leaf[at:to]], some)
            who = np.repeat(query[at:to], some)
            close = np.bitwise_count(self.signature[place] ^ marks[who]) <= (2 if same_length else 1)
            who, word = who[close], self.order[place[close]]
            for k in range(0, len(who), max(1, PAIRS * 8 // length)):
                w, x = who[k : k + max(1, PAIRS * 8 // length)], word[k : k + max(1, PAIRS * 8 // length)]
                if same_length:
                    hit = one_replaced(asked.letters(w, length), self.words.letters(x, length))
                else:
                    hit = one_deleted(asked.letters(w, length), self.words.letters(x, length + 1))
                yield w[hit], x[hit]
            at = to


def forest(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> dict[int, KdTree]:
    """For each length a tree of cells, from the ``sample`` words of least hash; as many leaves as the sample can tell."""
    sizes = {r.length: r.n for r in words.groupBy(F.length("w").alias("length")).agg(F.count("*").alias("n")).collect()}
    picked = words.orderBy(F.xxhash64("w"), "w").limit(sample).select("w").toArrow()["w"].combine_chunks()
    listed = WordList(picked if isinstance(picked, pa.Array) else pa.array([], pa.binary()))
    counts, total = listed.counts(), sum(sizes.values())
    out = {}
    for length in sorted(sizes):
        leaf = max(2, round(cell * len(listed) / total))
        out[length] = KdTree(counts[listed.lengths == length].astype(np.int16), leaf, tight=False)
    return out


def cells_of(lengths: np.ndarray, counts: np.ndarray, trees: dict[int, KdTree], longer: int, up: int, down: int):
    """(word, length, leaf): cells of length + ``longer`` that each word reaches."""
    who, at, leaves = [], [], []
    for length in np.unique(lengths):
        tree = trees.get(int(length) + longer)
        if tree is not None:
            own = np.flatnonzero(lengths == length)
            query, leaf = tree.search(counts[own], up, down)
            who.append(own[query])
            at.append(np.full(len(query), length + longer))
            leaves.append(leaf)
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) if x else none for x in (who, at, leaves))


def dealt(words: DataFrame, trees: dict[int, KdTree], tile: int = TILE) -> DataFrame:
    """(length, leaf, tile, kind, w, n): every word in its cell (kind 0) and in all cells to ask (1: own length, 2: the next)."""

    def places(counts_only: bool, large: dict[tuple[int, int], int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                column, n, mark = batch.column(0), batch.column(1), batch.column(2).to_numpy()
                listed = WordList(column)
                counts = listed.counts()
                for kind, (longer, up, down) in enumerate(((0, 0, 0), (0, 1, 1), (1, 1, 0))[: 1 if counts_only else 3]):
                    who, length, leaf = cells_of(listed.lengths, counts, trees, longer, up, down)
                    if large:
                        tiles = np.array([large.get(k, 1) for k in zip(length.tolist(), leaf.tolist())], np.int64)
                    else:
                        tiles = np.ones(len(who), np.int64)
                    if kind == 0:
                        which = mark[who] % tiles
                    else:  # askers go to every tile
                        which = np.arange(int(tiles.sum())) - np.repeat(np.cumsum(tiles) - tiles, tiles)
                        who, length, leaf = (np.repeat(x, tiles) for x in (who, length, leaf))
                    take = pa.array(who)
                    yield pa.record_batch(
                        [pa.array(x, pa.int32()) for x in (length, leaf, which, np.full(len(who), kind))] + [column.take(take), n.take(take)],
                        names=["length", "leaf", "tile", "kind", "w", "n"],
                    )

        return tidy(run)

    kinds = "length int, leaf int, tile int, kind int, w binary, n long"
    marked = words.select("w", "n", F.pmod(F.xxhash64("w"), F.lit(1 << 40)).alias("mark"))
    sizes = marked.mapInArrow(places(True, {}), kinds).groupBy("length", "leaf").agg(F.count("*").alias("n"))
    large = {(r.length, r.leaf): -(-r.n // tile) for r in sizes.where(F.col("n") > tile).collect()}
    return marked.mapInArrow(places(False, large), kinds)


def best(who: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(who, how many others, the other of largest ``n``, the first of ties) for each of ``who``."""
    order = np.lexsort((other, -n[other], who))
    who, other = who[order], other[order]
    first = np.flatnonzero(np.append(True, who[1:] != who[:-1])) if len(who) else np.zeros(0, np.int64)
    return who[first], np.diff(np.append(first, len(who))), other[first]


def ask_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (length, leaf, tile, kind, w): for each word and tile, its near words there and the best of them."""

    def found(askers: pa.Array, n: np.ndarray, cell: Cell, kind: int) -> Iterator[pa.RecordBatch]:
        pairs = list(cell.near(WordList(askers), kind == 1))
        who, word = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        # askers and words are both in code-point order, so places break ties
        sides = [(who, word, askers, cell.column, cell.n)]
        if kind == 2:
            sides.append((word, who, cell.column, askers, n))
        for own, other, own_words, other_words, other_n in sides:
            who_, count, top = best(own, other, other_n)
            yield pa.record_batch(
                [own_words.take(pa.array(who_)), pa.array(count, pa.int64()), pa.array(other_n[top], pa.int64()), other_words.take(pa.array(top))],
                names=["w", "near", "best_n", "best"],
            )

    current, parts, cell = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(4)])
        edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for at, to in zip([0, *edges], [*edges, batch.num_rows]):
            place, kind = tuple(keys[:3, at].tolist()), int(keys[3, at])
            words, n = batch.column(4).slice(at, to - at), batch.column(5).slice(at, to - at).to_numpy()
            if place != current:
                current, parts, cell = place, [], None
            if kind == 0:
                parts.append((words, n))
                continue
            if not parts:
                continue  # nobody lives there
            if cell is None:
                cell = Cell(pa.concat_arrays([w for w, _ in parts]), np.concatenate([x for _, x in parts]))
            yield from found(words, n, cell, kind)


def near_words(words: DataFrame, sample: int = SAMPLE, cell: int = CELL, tile: int = TILE) -> DataFrame:
    """(w, n_near, best_n, best) for every word of ``words`` (w, n; stored) that has a word one edit away."""
    asked = (
        dealt(words, forest(words, sample, cell), tile)
        .repartition("length", "leaf", "tile")
        .sortWithinPartitions("length", "leaf", "tile", "kind", "w")
    )
    return (
        asked.mapInArrow(tidy(ask_cells), "w binary, near long, best_n long, best binary")
        .groupBy("w")
        .agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("b"))).alias("top"))
        .select("w", "n_near", (-F.col("top.m")).alias("best_n"), F.col("top.b").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(w, root) from (w, form): forms followed to the last, by pointer doubling; every round doubles the steps."""
    pointers = stored(forms.select("w", F.col("form").alias("to")), "spelling-pointers")
    while True:
        step = pointers.select(F.col("w").alias("to"), F.col("to").alias("further"))
        joined = stored(pointers.join(step, "to", "left"), "spelling-steps")
        if not joined.where("further is not null").limit(1).count():
            return pointers.select("w", F.col("to").alias("root"))
        pointers = joined.select("w", F.coalesce("further", "to").alias("to"))


def variants(words: DataFrame, ratio: int = RATIO, **sizes: int) -> DataFrame:
    """(w, n, n_near, form, form_n, root) for every word of ``words`` (w, n; stored)."""
    near = stored(
        words.join(near_words(words, **sizes), "w", "left").withColumn("ok", F.col("best_n") >= F.col("n") * ratio), "spelling-near"
    ).select(
        "w",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("ok"), F.col("best")).alias("form"),
        F.when(F.col("ok"), F.col("best_n")).alias("form_n"),
    )
    led = roots(near.where("form is not null"))
    return near.join(led, "w", "left").withColumn("root", F.coalesce("root", "w"))


def digest(docs: DataFrame) -> DataFrame:
    found = variants(count_words(docs))
    text = lambda c: F.decode(F.col(c), "ISO-8859-1")
    return found.select(
        text("w").alias("word"), text("form").alias("form"), text("root").alias("root"), "n", "n_near", "form_n"
    )

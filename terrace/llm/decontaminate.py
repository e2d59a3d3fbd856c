"""Benchmark items in documents, by CGK embedding, bit-sampling LSH and exact edit verification.

Items and documents are sequences of lower-cased words. Items are grouped by
length (under eight words, to fifteen, to 31, longer). Windows of ``window`` words,
at most half of the group's shortest item, are taken at every word of every document,
and from each item at every third of a window, so that every item has several
windows, and one with few edits has windows with few, wherever the edits are. The
windows of items under eight words are so short that one of them is unedited.

The CGK walk reads a window with one pointer: at step j it outputs the word
under the pointer and moves on if bit j of the word's hash (a fresh one per
repetition) is set. Two windows a few edits apart fall back into step, so
their outputs differ at few steps. A repetition samples the first step and
three random later ones; windows that agree on all four are candidates. Samples are
compared one after the other, so that most windows are given up early, and the
first, the window's first word, is shared by all repetitions. How often repetitions
find the group's own items with ``MOST`` of their words edited is measured for every
length, and as many are taken as reach ``RECALL`` at each. Items of a length that
``MAX_REPETITIONS`` leave below are looked for exactly besides: cut into one piece more
than the edits allowed, one piece is unedited, and every place of every piece is a
candidate (a warning names the lengths). An unedited item is always found.

Each candidate is verified: the smallest word edit distance between the whole
item and any stretch of the document around the place must be at most
``MOST`` of the item's words (similarity 0.8).

Items reach the tasks with the function; they are read in blocks of at most
``BLOCK_ITEMS`` (all groups of a block together), each a pass over the documents, so a large benchmark costs
passes and not memory.

Defined cases: null, empty or blank texts and items match nothing; an item of
fewer than five words must occur exactly; repeated rows each get their
matches, repeated items (one ``item_id``) count once; null ids are carried
along; an empty benchmark or empty documents give no matches.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.words import Words, chunks, kinds_of, mix, pick_text, run_hash, tidy

U = np.uint64
MOST, RECALL = 0.2, 0.97
MAX_WINDOW, STEPS = 16, 21
BLOCK_ITEMS = 20_000
CHUNK = 1 << 20
MAX_REPETITIONS = 64
TRIALS = 100
HITS = "array<struct<item_id: long, distance: int, start: long, words: int>>"
_STEP = U(0xD1342543DE82EF95)


def walk_bits(tokens: np.ndarray, repetition: int) -> np.ndarray:
    """``STEPS`` moves of each word in a repetition; three repetitions share a hash."""
    with np.errstate(over="ignore"):
        fresh = mix(tokens ^ (U(repetition // 3 + 1) * U(0x9E3779B97F4A7C15)))
    return (fresh >> U(STEPS * (repetition % 3))).astype(np.uint32)


def sampled_steps(repetition: int, window: int) -> list[int]:
    """The three later steps that a repetition samples."""
    rng = np.random.default_rng([41, repetition])
    last = min(STEPS, max(4, round(1.4 * window)))
    return sorted(int(x) for x in rng.choice(np.arange(1, last), min(3, last - 1), replace=False))


def bitmap(signs: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 16, bool)
    bits[(signs >> U(48)).astype(np.int64)] = True
    return bits


def marked(bits: np.ndarray, signs: np.ndarray) -> np.ndarray:
    return np.flatnonzero(bits[(signs >> U(48)).astype(np.int32)])


def length_class(length: np.ndarray) -> np.ndarray:
    """Lengths that recall is measured for together: each on its own below 32 words, then eight an octave."""
    return np.where(length < 32, length, (8 * np.log2(np.maximum(length, 1))).astype(np.int64))


def window_of(shortest: int, most: float) -> int:
    """Words of a window: half of the shortest item; of items under eight words, what any edits within the limit spare."""
    if shortest < MAX_WINDOW // 2:
        return max(1, shortest // (int(most * shortest) + 1))
    return min(MAX_WINDOW, shortest // 2)


class Items:
    """A group of items: their windows and, per repetition, the sorted signatures of the windows.

    ``window``: words of a window, by default as many as the shortest item allows; ``grouped`` gives ``window_of``.
    """

    def __init__(
        self, ids: list, tokens: list[np.ndarray], most: float = MOST, recall: float = RECALL, window: int | None = None
    ):
        self.ids, self.tokens, self.most = ids, tokens, most
        self.window = window or max(1, min([MAX_WINDOW, *map(len, tokens)]))
        self.limit = np.array([int(most * len(t)) for t in tokens], np.int64)
        self.length = np.array([len(t) for t in tokens], np.int64)
        item, offset, stride = [], [], max(1, self.window // 3)
        for i, t in enumerate(tokens):
            starts = sorted({*range(0, len(t) - self.window + 1, stride), len(t) - self.window})
            item += [i] * len(starts)
            offset += starts
        self.item, self.offset = np.array(item, np.int64), np.array(offset, np.int64)
        self.flat = np.concatenate([np.zeros(0, U), *tokens])
        first = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64)
        self.starts = first[self.item] + self.offset
        self.heads = bitmap(mix(self.flat[self.starts]))
        # codes of (item, word) pairs, to drop candidates that share too few; words of one code count once
        self.distinct = np.array([len(np.unique(pair_code(np.array(i), t))) for i, t in enumerate(tokens)], np.int64)
        self.pairs = bitmap20(np.repeat(np.arange(len(tokens)), self.length), self.flat)
        self.tables: list = []
        self._repeat_until(recall)

    def _add(self, r: int) -> None:
        at, sign = self.starts, mix(self.flat[self.starts])
        maps = []
        for part in later_signs(self.flat, walk_bits(self.flat, r), at, sign, self.window, sampled_steps(r, self.window)):
            maps.append(bitmap(part))
            sign = part
        order = np.argsort(sign, kind="stable")
        self.tables.append((maps, sign[order], order))

    def _repeat_until(self, recall: float) -> None:
        rng = np.random.default_rng(7)
        kind_of = length_class(self.length)
        asked = np.concatenate([rng.choice(np.flatnonzero(kind_of == k), TRIALS) for k in np.unique(kind_of)])
        texts, trial = [], []
        for n, i in enumerate(asked):
            words = self.tokens[i].tolist()
            for _ in range(int(self.limit[i])):
                k, new, kind = int(rng.integers(len(words))), int(rng.integers(1 << 62)), int(rng.integers(3))
                words[k : k + (kind != 0)] = [] if kind == 1 and len(words) > 1 else [new]
            pad = rng.integers(1 << 62, size=MAX_WINDOW).tolist()
            texts.append(np.array(words + pad, U))
            trial += [n] * len(texts[-1])
        flat, trial = np.concatenate(texts), np.array(trial)
        starts = np.arange(len(flat) - self.window + 1)
        found = np.zeros(len(asked), bool)
        self.recall = {k: 0.0 for k in np.unique(kind_of).tolist()}
        while min(self.recall.values()) < recall and len(self.tables) < MAX_REPETITIONS:
            r = len(self.tables)
            self._add(r)
            at, which = agreeing(flat, starts, self, r)
            own = self.item[which] == asked[trial[at]]
            found[trial[at][own]] = True
            self.recall = {k: float(found[kind_of[asked] == k].mean()) for k in self.recall}
        short = [k for k, v in self.recall.items() if v < recall]
        if short:
            low = {int(self.length[kind_of == k].min()): self.recall[k] for k in short}
            note = f"recall below {recall} after {len(self.tables)} repetitions, these are searched exactly; by words of an item: {low}"
            warnings.warn(note, stacklevel=2)
        self._cut(np.flatnonzero(np.isin(kind_of, short)))

    def _cut(self, chosen: np.ndarray) -> None:
        """Pieces of the items ``chosen``, by length: sorted hashes, items, places in the item."""
        held: dict[int, list[tuple[int, int, int]]] = {}
        for i in chosen.tolist():
            n = int(self.length[i]) // (int(self.limit[i]) + 1)
            hashes = run_hash(self.tokens[i], n)
            held.setdefault(n, []).extend((int(hashes[k * n]), i, k * n) for k in range(int(self.limit[i]) + 1))
        self.pieces = {}
        for n, found in held.items():
            found.sort()
            self.pieces[n] = (np.array([f[0] for f in found], U), *(np.array([f[j] for f in found], np.int64) for j in (1, 2)))


def bitmap20(item: np.ndarray, word: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 20, bool)
    bits[pair_code(item, word)] = True
    return bits


def pair_code(item: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((word + item.astype(U) * U(0x9E3779B97F4A7C15)) * _STEP >> U(44)).astype(np.int32)


def later_signs(tokens, bits, begun, sign, window: int, steps: list[int]) -> Iterator[np.ndarray]:
    """Running signatures after each of ``steps`` (words past a window are 0); send indices to go on with those only."""
    at, j = begun, 0
    for step in steps:
        while j < step:
            move = ((bits[at] >> np.uint32(j)) & np.uint32(1)).astype(at.dtype)
            at = at + move
            j += 1
            if j >= window:  # only then can the pointer have passed the window's last word
                at = np.minimum(at, np.minimum(begun + window, len(tokens) - 1).astype(at.dtype))
        word = tokens[at]
        if j >= window:
            word = np.where(at < begun + window, word, U(0))
        with np.errstate(over="ignore"):
            sign = mix(sign * _STEP + word)
        kept = yield sign
        if kept is not None:
            begun, at, sign = begun[kept], at[kept], sign[kept]
            yield sign


def agreeing(tokens: np.ndarray, begun: np.ndarray, items: Items, r: int) -> tuple[np.ndarray, np.ndarray]:
    """(window start, item window) pairs that agree in repetition ``r``; ``begun``: starts whose first word is known."""
    maps, signs, order = items.tables[r]
    walk = later_signs(
        tokens, walk_bits(tokens, r), begun, mix(tokens[begun]), items.window, sampled_steps(r, items.window)
    )
    for bits in maps:
        kept = marked(bits, next(walk))
        sign = walk.send(kept)
        begun = begun[kept]
    lo, hi = np.searchsorted(signs, sign, "left"), np.searchsorted(signs, sign, "right")
    count = hi - lo
    which = np.repeat(np.arange(len(sign)), count)
    place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + lo[which]
    return begun[which].astype(np.int64), order[place]


def piece_places(words: Words, items: Items, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, item, place in the item) of every occurrence of the items' pieces of ``length`` words."""
    hashes, item, offset = items.pieces[length]
    own = run_hash(words.hash, length) if len(words.hash) >= length else np.zeros(0, U)
    lo, hi = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
    hi[np.arange(len(own)) + length > words.first[1:][words.rows()[: len(own)]]] = 0  # past the text's end
    count = np.maximum(hi - lo, 0)
    at = np.repeat(np.arange(len(own)), count)
    which = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + lo[at]
    return at, item[which], offset[which]


def candidates(words: Words, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, where the item would start) of windows that agree in some repetition, each once."""
    tokens = words.hash
    row_of = words.rows()
    begun = np.flatnonzero(np.arange(len(tokens)) + items.window <= words.first[1:][row_of]).astype(np.int32)
    begun = begun[marked(items.heads, mix(tokens[begun]))]
    found, n = [np.zeros(0, np.int64)], len(items.starts)
    for r in range(len(items.tables)):
        at, which = agreeing(tokens, begun, items, r)
        found.append(at * n + which)
    pairs = np.unique(np.concatenate(found))
    at, which = pairs // n, pairs % n
    item, offset = items.item[which], items.offset[which]
    for length in items.pieces:
        more = piece_places(words, items, length)
        at, item, offset = (np.concatenate(x) for x in zip((at, item, offset), more))
    span = len(tokens) + int(items.length.max())
    key, one = np.unique(item * (2 * span) + at - offset + span, return_index=True)
    item, base, at = key // (2 * span), key % (2 * span) - span, at[one]
    row = row_of[at]
    # too few of the item's distinct words around: no need for the exact distance
    enough, reach = np.zeros(len(at), bool), np.arange(-int(items.limit.max()), int((items.length + items.limit).max()))
    for lo in range(0, len(at), 4096):
        i, b = item[lo : lo + 4096], base[lo : lo + 4096]
        place = b[:, None] + reach
        inside = (reach >= -items.limit[i][:, None]) & (reach < (items.length[i] + items.limit[i])[:, None])
        inside &= (place >= 0) & (place < len(tokens))
        code = pair_code(i[:, None], tokens[np.clip(place, 0, len(tokens) - 1)])
        inside &= items.pairs[code]
        least = items.distinct[i] - items.limit[i]
        some = np.flatnonzero(inside.sum(axis=1) >= least)
        seen = np.sort(np.where(inside[some], code[some], -1), axis=1)
        kinds = (seen[:, 1:] != seen[:, :-1]).sum(axis=1) + (seen[:, 0] >= 0)
        enough[lo + some] = kinds >= least[some]
    return row[enough], item[enough], base[enough]


def best_distance(item: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``text`` (n, width): least edit distance of ``item`` to any stretch, and where that ends."""
    n, m = len(text), len(item)
    steps = np.arange(m + 1, dtype=np.int32)
    column = np.broadcast_to(steps, (n, m + 1)).copy()
    best, end = column[:, m].copy(), np.zeros(n, np.int64)
    for j in range(text.shape[1]):
        new = np.empty_like(column)
        new[:, 0] = 0
        new[:, 1:] = np.minimum(column[:, 1:] + 1, column[:, :-1] + (text[:, j, None] != item[None, :]))
        column = np.minimum.accumulate(new - steps, axis=1) + steps
        better = column[:, m] < best
        best[better], end[better] = column[better, m], j + 1
    return best, end


def verified(words: Words, items: Items, row: np.ndarray, item: np.ndarray, base: np.ndarray):
    """(row, item): (distance, start, words) of the candidates within the limit, the best of each row and item."""
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i in np.unique(item):
        tokens, most = items.tokens[i], int(items.limit[i])
        places = np.unique(np.stack([row[item == i], base[item == i]], 1), axis=0)
        reach = len(tokens) + 2 * most
        for lo in range(0, len(places), 1024):
            r, begin = places[lo : lo + 1024].T
            first, last = words.first[r], words.first[r + 1]
            place = begin[:, None] - most + np.arange(reach)
            inside = (place >= first[:, None]) & (place < last[:, None])
            text = np.where(inside, words.hash[np.clip(place, 0, len(words.hash) - 1)], U(0))
            best, end = best_distance(tokens, text)
            for k in np.flatnonzero(best <= most):
                stop = int(begin[k] - most + end[k] - first[k])
                hit = (int(best[k]), max(0, stop - len(tokens)), len(tokens))
                out[int(r[k]), int(i)] = min(out.get((int(r[k]), int(i)), hit), hit)
    return out


def grouped(ids: list, tokens: list[np.ndarray]) -> list[Items]:
    """Items of like length share windows, so that long items are not held to a short one's window."""
    by_length: dict[int, list[int]] = {}
    for k, t in enumerate(tokens):
        n = len(t)
        by_length.setdefault(n if n < MAX_WINDOW // 2 else min(2 * MAX_WINDOW, 1 << n.bit_length() - 1), []).append(k)
    out = []
    for _, group in sorted(by_length.items()):
        own = [tokens[k] for k in group]
        out.append(Items([ids[k] for k in group], own, window=window_of(min(map(len, own)), MOST)))
    return out


def item_blocks(benchmark: DataFrame) -> Iterator[list[Items]]:
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("text is not null")
    n_blocks = max(1, math.ceil(texts.count() / (BLOCK_ITEMS / 2)))
    for b in range(n_blocks):
        rows = texts.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).orderBy("item_id", "text").collect()
        ids, tokens = [], []
        for _, _, data, offsets in chunks(pc.utf8_lower(pa.array([r["text"] for r in rows], pa.string())), 1 << 40):
            words = Words(data, offsets)
            for i, r in enumerate(rows):
                own = words.hash[words.first[i] : words.first[i + 1]]
                if len(own):
                    ids.append(r["item_id"])
                    tokens.append(own)
        if ids:
            yield grouped(ids, tokens)


def find(docs: DataFrame, carry: list[str], benchmark: DataFrame) -> DataFrame:
    """The columns ``carry`` of every row of ``docs``, and ``__hits``: its benchmark items."""
    out, text_at = pick_text(docs, carry, F.array().cast(HITS).alias("__hits"))
    kinds = ", ".join(kinds_of(out, out.columns))
    hit_type = pa.list_(
        pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int64()), ("words", pa.int32())])
    )
    for groups in item_blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], groups=groups) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns, lists = batch.columns, []
                before = columns[len(carry)].to_pylist()
                for at, to, data, offsets in chunks(pc.utf8_lower(columns[text_at]), CHUNK):
                    words = Words(data, offsets)
                    own: list[list] = [[] for _ in range(to - at)]
                    for items in groups if len(words.hash) else ():
                        for (row, i), (distance, start, n) in verified(words, items, *candidates(words, items)).items():
                            own[row].append((items.ids[i], distance, start, n))
                    lists += own
                merged = [
                    b + [dict(zip(("item_id", "distance", "start", "words"), h)) for h in sorted(x, key=str)]
                    for b, x in zip(before, lists)
                ]
                columns[len(carry)] = pa.array(merged, hit_type)
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        out = out.mapInArrow(tidy(run), kinds)
    return out.select(*carry, "__hits")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns unchanged."""
    return find(docs, docs.columns, benchmark).where(F.size("__hits") == 0).drop("__hits")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: distance, first word and words of the best place."""
    found = find(docs, ["doc_id"], benchmark).select("doc_id", F.explode("__hits").alias("h"))
    return (
        found.groupBy("doc_id", F.col("h.item_id").alias("item_id"))
        .agg(F.min(F.struct("h.distance", "h.start", "h.words")).alias("b"))
        .select("doc_id", "item_id", F.col("b.distance").cast("long").alias("distance"), "b.start", F.col("b.words").cast("long").alias("words"))
    )

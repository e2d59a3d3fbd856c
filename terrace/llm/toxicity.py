"""Toxicity by a support vector machine over a subsequence string kernel with Nyström landmarks.

Kernel. A word is its letters (A-Z as a-z) between two end marks. Two words share a
subsequence of ``LETTERS`` letters even if other letters stand in between: an
occurrence with ``g`` letters left out weighs ``DECAY**g``, up to ``SPAN`` letters in
all, and signs within a word are gaps that cost nothing. The kernel of two words is
the sum over shared subsequences, divided by the norms (the weights' root sum of
squares), to the power ``POWER``; the kernel of two sentences is the sum over their words. So "idiot",
"i.d.i.o.t", "i d i o t" and "idxiot" are near each other: a run of three or more single
letters counts as one word.

Nyström. ``LANDMARKS`` words of the training sentences, up to half of them those that best tell
toxic from clean documents and the rest by hash, span the feature space: a sentence
is K(sentence, landmarks) times the inverse root of K(landmarks, landmarks). A linear
machine with squared hinge loss is trained on sentences. Only documents have
labels: sentences of clean documents are clean; a sentence of a toxic document is toxic if it
holds a word that tells, and is left out otherwise. ``COPIES`` of such a sentence have a letter
put into each word that tells, so the machine meets inserted letters. A word's part in a margin does not
depend on its sentence, so a task computes it once for each distinct word.

A document's score is a logistic function of its highest sentence margin, the
mean of its three highest, and how many are above zero, fitted on labelled documents
that the machine was not trained on, with toxic ones weighing ``SHARE`` of all.

Training sample: at most ``MAX_DOCS`` labelled documents of each class, chosen by
a hash of the id outside the held-out fold, of at most ``MAX_CHARS`` characters
each and ``MAX_TOTAL`` in all; trained on the driver. Scoring runs in tasks, over everything.

Defined cases: a null, empty or blank text has no sentence and gets the score that the
logistic gives it; rows are scored one by one, so repeated rows and null ids
change nothing (a null id is not held out); a null label is no label; without labels
of both classes every score is 0; an empty table gives none. Labels, lang, source
and doc_id are no inputs of a score. A column carried along that is named ``score``
is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.words import U, Words, chunks, kinds_of, lean, mix, pick_text, tidy

LETTERS, DECAY, SPAN, POWER = 4, 0.75, 7, 3
LANDMARKS = 128
MAX_DOCS, MAX_CHARS, MAX_TOTAL = 800, 20_000, 5_000_000
SENTENCE = 24
RIDGE, COST = 1.0, 500.0
#: Landmarks that weigh less than this share of the heaviest are left out of scoring.
FAINT = 0.1
SHARE = 0.35
#: Training copies of a toxic sentence with letters put in.
COPIES = 2
CHUNK = 4 << 20
#: Word scores a task remembers.
REMEMBERED = 1 << 20
OPEN, CLOSE, BITS = 62, 63, 6


def letter_codes() -> np.ndarray:
    """A code per byte: letters 1 to 26, digits 27 to 36, continuation bytes 37 to 61, other bytes 0 (a gap), lead bytes 255 (left out)."""
    codes = np.zeros(256, np.uint8)
    codes[65:91] = codes[97:123] = np.arange(1, 27)
    codes[48:58] = np.arange(27, 37)
    codes[0x80:0xC0] = 37 + np.arange(64) % 25
    codes[0xC0:] = 255
    return codes


def steps() -> list[tuple[tuple[int, ...], float]]:
    """Places of the later letters behind the first, and the weight of that many gaps."""
    return [(c, DECAY ** (c[-1] - LETTERS + 1)) for c in combinations(range(1, SPAN), LETTERS - 1)]


class Units:
    """The words of a run of texts as the kernel sees them, with the sentence of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets, lower=True)
        starts, ends, hashes, row = words.starts, words.ends, words.hash, words.rows()
        codes = letter_codes()[data]
        letter = np.flatnonzero((codes > 0) & (codes < 255))
        inside = np.searchsorted(letter, ends) - np.searchsorted(letter, starts)
        single = inside == 1
        before = np.zeros(len(starts), bool)
        before[1:] = single[1:] & single[:-1] & (row[1:] == row[:-1])
        first = np.flatnonzero(~before)
        size = np.diff(np.append(first, len(starts)))
        # runs of three single letters and more are one word; shorter ones stay apart
        short = np.repeat(size, size) < 3
        first = np.flatnonzero(~before | short)
        last = np.append(first[1:], len(starts)) - 1 if len(first) else first
        if len(first):
            with np.errstate(over="ignore"):
                place = (np.arange(len(starts)) - np.repeat(first, last - first + 1)).astype(U)
                hashes = np.add.reduceat(mix(hashes + place), first)
        self.starts, self.ends, self.hash, self.row = starts[first], ends[last], hashes, row[first]
        self.data, self.offsets, self.codes, self.letter, self.n_rows = data, offsets, codes, letter, len(offsets) - 1
        self.sentence = self._sentences()

    def _sentences(self) -> np.ndarray:
        """The number of each word's sentence: ends at . ! ? or a line's end, or after ``SENTENCE`` words."""
        n = len(self.starts)
        if not n:
            return np.zeros(0, np.int64)
        lines = np.flatnonzero(self.data == 10)
        stop = np.isin(self.data[self.ends - 1], np.frombuffer(b".!?", np.uint8))
        new = np.ones(n, bool)
        crossed = np.searchsorted(lines, self.starts[1:]) > np.searchsorted(lines, self.ends[:-1])
        new[1:] = stop[:-1] | crossed | (self.row[1:] != self.row[:-1])
        first = np.flatnonzero(new)
        within = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        return np.cumsum(new | (within % SENTENCE == 0)) - 1

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(an occurrence of each distinct word, which of them every word is)."""
        _, first, which = np.unique(self.hash, return_index=True, return_inverse=True)
        return first, which

    def layout(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the words ``which`` one behind the other, each from its first to its last letter, marked and padded; and where each starts."""
        at = np.searchsorted(self.letter, self.starts[which])
        to = np.searchsorted(self.letter, self.ends[which])
        held = to > at
        lo = np.where(held, self.letter[np.minimum(at, len(self.letter) - 1)], 0) if len(self.letter) else np.zeros(len(which), np.int64)
        hi = np.where(held, self.letter[np.maximum(to - 1, 0)] + 1, 0) if len(self.letter) else lo
        n = hi - lo
        room = n + SPAN + 1
        starts = np.cumsum(room) - room
        out = np.zeros(int(room.sum()) + SPAN, np.uint8)
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(starts + 1, n) + place] = self.codes[np.repeat(lo, n) + place]
        out[starts[held]] = OPEN
        out[(starts + n + 1)[held]] = CLOSE
        keep = (out > 0) & (out < 255)  # signs inside a word are free gaps; of a letter of several bytes the later ones speak
        keep[(starts[:, None] + (n + 2)[:, None] + np.arange(SPAN - 1)).ravel()] = True
        moved = np.cumsum(keep) - keep
        return out[np.append(np.flatnonzero(keep), np.arange(len(out) - SPAN, len(out)))], moved[starts]


def subsequences(layout: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(first place, key, weight) of the subsequences, one pattern of gaps after the other."""
    n = len(layout) - SPAN
    code = layout.astype(np.int32)
    for places, weight in steps():
        key, held = code[:n], layout[:n] > 0
        for p in places:
            key, held = (key << BITS) | code[p : n + p], held & (layout[p : n + p] > 0)
        at = np.flatnonzero(held)
        yield at, key[at], weight


def norms(layout: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The root of the summed squared weights of each word."""
    total = np.zeros(len(layout), np.float32)
    for at, _, weight in subsequences(layout):
        total[at] += weight * weight
    return np.sqrt(np.maximum(np.add.reduceat(total, starts), 1e-6)) if len(starts) else np.zeros(0, np.float32)


class Landmarks:
    """The subsequences of the landmark words, and kernels against them."""

    def __init__(self, units: Units, which: np.ndarray):
        layout, starts = units.layout(which)
        keys, owners, weights = [], [], []
        for at, key, weight in subsequences(layout):
            keys.append(key)
            owners.append(np.searchsorted(starts, at, "right") - 1)
            weights.append(np.full(len(at), weight))
        keys, owners, weights = (np.concatenate(x) for x in (keys, owners, weights))
        self.keys, at = np.unique(keys, return_inverse=True)
        self.rows = np.zeros((len(self.keys) + 1, len(which)), np.float32)  # the last: what no landmark has
        np.add.at(self.rows, (at, owners), weights)
        self.rows /= norms(layout, starts)
        self._row_of = None

    def __getstate__(self):
        return {**self.__dict__, "_row_of": None}

    def kernel(self, units: Units, which: np.ndarray, of=None, step: int = 1 << 13) -> np.ndarray:
        """(words, landmarks), or what ``of`` makes of each block of it."""
        if self._row_of is None:
            self._row_of = np.full(1 << LETTERS * BITS, len(self.keys), np.uint16 if len(self.keys) < 1 << 16 else np.int32)
            self._row_of[self.keys] = np.arange(len(self.keys))
        out = []
        for at in range(0, len(which), step):
            layout, starts = units.layout(which[at : at + step])
            block = np.zeros((len(starts), self.rows.shape[1]), np.float32)
            square = np.zeros(len(layout), np.float32)
            for place, key, weight in subsequences(layout):
                square[place] += weight * weight
                row = self._row_of[key]
                met = np.flatnonzero(row < len(self.keys))
                if len(met):
                    owner = np.searchsorted(starts, place[met], "right") - 1
                    cut = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                    block[owner[cut]] += np.add.reduceat(self.rows[row[met]], cut) * np.float32(weight)
            norm = np.sqrt(np.maximum(np.add.reduceat(square, starts), 1e-6))
            block = (block / norm[:, None]) ** POWER
            out.append(of(block) if of else block)
        return np.concatenate(out) if out else np.zeros((0, self.rows.shape[1]), np.float32)


class Machine:
    """The machine's weight for each landmark, its offset and the documents' logistic."""

    def __init__(self, marks: Landmarks, weights: np.ndarray, offset: float, platt: np.ndarray):
        self.marks, self.weights, self.offset, self.platt = marks, weights, offset, platt

    def word_scores(self, units: Units, which: np.ndarray) -> np.ndarray:
        """What each of the words ``which`` adds to the margin of a sentence."""
        return self.marks.kernel(units, which, lambda k: k @ self.weights)

    def margins(self, units: Units, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sentence margins, first sentence of each row and the end); a row without words has none."""
        if not len(units.starts):
            return np.zeros(0), np.zeros(units.n_rows + 1, np.int64)
        first = np.flatnonzero(np.append(True, units.sentence[1:] != units.sentence[:-1]))
        margins = np.add.reduceat(scores.astype(np.float64), first) + self.offset
        return margins, np.searchsorted(units.row[first], np.arange(units.n_rows + 1))

    def summaries(self, units: Units) -> np.ndarray:
        first, which = units.distinct()
        margins, bounds = self.margins(units, self.word_scores(units, first)[which])
        return summary(margins, bounds, self.offset)

    def documents(self, summaries: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summaries @ self.platt, -30, 30)))


def summary(margins: np.ndarray, bounds: np.ndarray, none: float) -> np.ndarray:
    """Per document: 1, the highest margin, the mean of the three highest, log of how many are above 0."""
    sizes = np.diff(bounds)
    row = np.repeat(np.arange(len(sizes)), sizes)
    ranked = margins[np.lexsort((-margins, row))]
    out = np.full((len(sizes), 4), none)
    out[:, 0] = 1
    full = np.flatnonzero(sizes)
    out[full, 1] = ranked[bounds[full]]
    for k in (1, 2):  # shorter documents repeat their last
        out[full, 2] += ranked[bounds[full] + np.minimum(k, sizes[full] - 1)]
    out[full, 2] = (out[full, 2] - none + out[full, 1]) / 3
    out[:, 3] = np.log1p(np.bincount(row, margins > 0, len(sizes)))
    return np.clip(out, -4, 4)


def pick_landmarks(units: Units, first: np.ndarray, which: np.ndarray, toxic: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``first`` of the landmark words, and whether each word tells: holds a run chosen by class, and is itself three times as frequent in toxic rows; ``toxic``: label of each row.

    At most half of them by class: runs of ``LETTERS`` letters that toxic rows hold more
    often than chance allows (likelihood ratio against the number of runs tried),
    the best one first, each by the word that brings it to most toxic rows, if toxic
    rows hold that word three times as often as clean ones; a toxic row counts half
    as much for every run that it holds already. The others by hash.
    """
    layout, starts = units.layout(first)
    code = layout.astype(np.int64)
    at = np.arange(len(layout) - SPAN)
    runs, solid = code[at], layout[at] > 0
    for k in range(1, LETTERS):
        runs, solid = (runs << BITS) | code[at + k], solid & (layout[at + k] > 0)
    at = np.flatnonzero(solid)
    kinds, run_of = np.unique(runs[at], return_inverse=True)
    owner = np.searchsorted(starts, at, "right") - 1
    n_runs, from_run = np.bincount(owner, minlength=len(first)), np.append(0, np.cumsum(np.bincount(owner, minlength=len(first))))
    each = np.unique(which.astype(np.int64) * units.n_rows + units.row)
    word, row = each // units.n_rows, each % units.n_rows
    lean_to = np.bincount(word, toxic[row], len(first)) / max(1, toxic.sum()) - 3 * np.bincount(word, 1 - toxic[row], len(first)) / max(1, (1 - toxic).sum())
    place = np.arange(int(n_runs[word].sum())) - np.repeat(np.cumsum(n_runs[word]) - n_runs[word], n_runs[word])
    held_by = np.unique(run_of[np.repeat(from_run[word], n_runs[word]) + place] * units.n_rows + np.repeat(row, n_runs[word]))
    run, row = held_by // units.n_rows, held_by % units.n_rows
    share, held = toxic.mean(), np.bincount(run, minlength=len(kinds))
    own = np.clip(np.bincount(run, toxic[row], len(kinds)) / np.maximum(held, 1), 1e-9, 1 - 1e-9)
    ratio = held * (own * np.log(own / share) + (1 - own) * np.log((1 - own) / (1 - share)))
    ratio[(own <= share) | (ratio < np.log(max(1, len(kinds))) + 3)] = 0
    weight, by_class, telling = toxic.astype(float), [], np.zeros(len(first), bool)
    by_run = np.searchsorted(run, np.arange(len(kinds) + 1))
    words_of = np.argsort(run_of, kind="stable")
    from_word = np.searchsorted(run_of[words_of], np.arange(len(kinds) + 1))
    while len(by_class) < n // 2:
        value = ratio * np.bincount(run, weight[row], len(kinds)) / np.maximum(held, 1)
        if value.max(initial=0) <= 0:
            break
        best = int(value.argmax())
        ratio[best] = 0
        weight[row[by_run[best] : by_run[best + 1]]] /= 2
        words = owner[words_of[from_word[best] : from_word[best + 1]]]
        words = words[lean_to[words] > 0]
        telling[words] = True
        words = np.setdiff1d(words, by_class)
        if len(words):
            by_class.append(int(words[np.lexsort((units.hash[first][words], -lean_to[words]))[0]]))
    rest = np.setdiff1d(np.flatnonzero(n_runs), by_class)
    rest = rest[np.argsort(mix(units.hash[first][rest] ^ U(77)))][: n - n // 2]
    return np.concatenate([by_class, rest]).astype(np.int64), telling


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights of the primal machine by Newton steps, halved until the loss falls; the last column of ``x`` is 1 and is not penalised."""
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6

    def loss(margin, w):
        return (cost * np.maximum(1 - y * margin, 0) ** 2).sum() + (ridge * w * w).sum()

    w = np.zeros(x.shape[1])
    margin = x @ w
    for _ in range(rounds):
        active = y * margin < 1
        held, c = x[active].astype(np.float64), cost[active]
        target = np.linalg.solve((held * c[:, None]).T @ held + np.diag(ridge), held.T @ (c * y[active]))
        size, now = 1.0, loss(margin, w)
        while size > 1e-4:
            tried = w + size * (target - w)
            if loss(x @ tried, tried) < now:
                break
            size /= 2
        else:
            break
        done = np.abs(tried - w).max() < 1e-6
        w, margin = tried, x @ tried
        if done:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression with a small ridge, the class 1 weighing ``share`` of all; Newton steps, halved until the loss falls."""
    cost = np.where(y > 0, share / max(1, (y > 0).sum()), (1 - share) / max(1, (y <= 0).sum()))
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(w):
        z = np.clip(x @ w, -50, 50)
        return (cost * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (penalty * w * w).sum()

    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (cost * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (cost * (p - y)) + penalty * w)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def joined(texts: list[bytes]) -> Units:
    return Units(np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64))


def with_letters(word: bytes) -> list[bytes]:
    """``word`` with one letter put in: at each place inside it the letter before it again, and one that changes with the place."""
    word = b"".join(word.split())
    return [word[:k] + more + word[k:] for k in range(2, len(word)) for more in (word[k - 1 : k], b"%c" % (97 + 7 * (len(word) + k) % 26))] or [word]


def altered(units: Units, first: np.ndarray, which: np.ndarray, z: np.ndarray, features, telling: np.ndarray, bounds: list[tuple[int, int]], x: np.ndarray) -> np.ndarray:
    """``COPIES`` of each sentence (rows of ``x``; ``bounds``: its words) with a letter put into every word that tells.

    ``z``: features of the distinct words; ``features``: those of all words of some units.
    """
    words = np.flatnonzero(telling)
    number, spelt, starts = np.full(len(first), -1), [], [0]
    number[words] = np.arange(len(words))
    for at in first[words]:
        spelt += with_letters(units.data[units.starts[at] : units.ends[at]].tobytes())
        starts.append(len(spelt))
    new = features(joined(spelt))
    out = np.repeat(x, COPIES, axis=0)
    for i, (lo, hi) in enumerate(bounds):
        held = which[lo:hi]
        for word in held[telling[held]]:
            at, n = starts[number[word]], starts[number[word] + 1] - starts[number[word]]
            for c in range(COPIES):
                out[i * COPIES + c, :-1] += new[at + (i * COPIES + c) * 7 % n] - z[word]
    return out


def train_machine(units: Units, toxic: np.ndarray) -> Machine:
    """The machine of labelled rows, without the documents' logistic."""
    first, which = units.distinct()
    picked, telling = pick_landmarks(units, first, which, toxic, LANDMARKS)
    picked = first[picked]
    marks = Landmarks(units, picked)
    values, vectors = np.linalg.eigh(marks.kernel(units, picked).astype(np.float64))
    good = values > 1e-4 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    z = (marks.kernel(units, first) @ root).astype(np.float32)
    cut = np.flatnonzero(np.append(True, units.sentence[1:] != units.sentence[:-1]))
    x = np.ones((len(cut), z.shape[1] + 1), np.float32)
    for at in range(0, len(cut), 1 << 13):
        some = cut[at : at + (1 << 13)]
        end = cut[at + (1 << 13)] if at + (1 << 13) < len(cut) else len(which)
        x[at : at + (1 << 13), :-1] = np.add.reduceat(z[which[some[0] : end]], some - some[0])
    bad = toxic[units.row[cut]] > 0
    told = np.maximum.reduceat(telling[which], cut)
    y = np.where(bad, 1.0, -1.0)
    used = told | ~bad if (told & bad).any() else np.ones(len(cut), bool)
    x, y = x[used], y[used]
    bounds = [(lo, hi) for lo, hi, own in zip(cut, np.append(cut[1:], len(which)), told & bad) if own]
    if bounds:
        features = lambda some: (marks.kernel(some, np.arange(len(some.starts))) @ root).astype(np.float32)
        more = altered(units, first, which, z, features, telling, bounds, x[y > 0])
        x, y = np.concatenate([x, more]), np.append(y, np.ones(len(more)))
    cost = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) * COST
    w = squared_hinge(x, y, cost)
    weights = root @ w[:-1]
    heavy = np.abs(weights) >= FAINT * np.abs(weights).max()
    marks = Landmarks(units, picked[heavy])
    return Machine(marks, weights[heavy].astype(np.float32), float(w[-1]), np.zeros(4))


def learn(texts: list[bytes], toxic: np.ndarray, share: float = SHARE) -> Machine | None:
    """The machine of two thirds of the labelled texts, the documents' logistic of the others; None without both classes in both.

    ``share``: of toxic documents among all, for the logistic.
    """
    fitted = np.arange(len(texts)) % 3 == 2
    if min((len(set(toxic[own].tolist())) for own in (fitted, ~fitted)), default=0) < 2:
        return None
    units = joined([t for t, f in zip(texts, fitted) if not f])
    if not len(units.letter):
        return None
    machine = train_machine(units, toxic[~fitted])
    rest = machine.summaries(joined([t for t, f in zip(texts, fitted) if f]))
    machine.platt = logistic(rest, toxic[fitted].astype(float), share)
    return machine


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(mark, id, toxic, text) of at most ``max_docs`` labelled ids of each class outside the held-out fold."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    key = F.col("doc_id").cast("string")
    known = usable.select(F.xxhash64(F.lit(12), key).alias("mark"), key.alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.groupBy("mark", "id").agg(F.max("toxic").alias("toxic"))
    picked = [known.where(F.col("toxic") == y).orderBy("mark", "id").limit(max_docs) for y in (0, 1)]
    texts = lean(docs).select(key.alias("id"), F.col("text").cast("string").alias("text"))
    short = texts.where(F.col("text").isNotNull() & (F.length("text") <= MAX_CHARS))
    met = short.join(F.broadcast(picked[0].union(picked[1])), "id")  # 2 * max_docs rows at most
    return met.select("mark", "id", "toxic", "text").orderBy("mark", "id", "text").limit(2 * max_docs)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Machine | None:
    """The machine of a bounded sample of labelled documents; None without both classes."""
    got = sample(docs, labels, max_docs).toArrow()
    texts, size = [], 0
    for text in got["text"].to_pylist():
        size += len(text)
        if size > MAX_TOTAL:
            break
        texts.append(text.encode())
    return learn(texts, got["toxic"].to_numpy()[: len(texts)])


class Memory:
    """Scores of words that a task has seen."""

    def __init__(self, machine: Machine):
        self.machine, self.hashes, self.scores = machine, np.zeros(0, U), np.zeros(0, np.float32)

    def scores_of(self, units: Units) -> np.ndarray:
        first, which = units.distinct()
        hashes = units.hash[first]  # rising
        at = np.searchsorted(self.hashes, hashes)
        known = np.append(self.hashes, U(0))[at] == hashes if len(self.hashes) else np.zeros(len(first), bool)
        known &= at < len(self.hashes)
        out = np.zeros(len(first), np.float32)
        out[known] = self.scores[at[known]]
        out[~known] = self.machine.word_scores(units, first[~known])
        if len(self.hashes) > REMEMBERED:
            self.hashes, self.scores = hashes, out
        else:
            self.hashes = np.insert(self.hashes, at[~known], hashes[~known])
            self.scores = np.insert(self.scores, at[~known], out[~known])
        return out[which]


def score(docs: DataFrame, machine: Machine | None, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of every row, and ``score`` (0 to 1, higher: more toxic)."""
    if "score" in carry:
        raise ValueError("a carried column is named score")
    picked, text_at = pick_text(docs, carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(machine) if machine is not None else None
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(text_at), CHUNK):
                scores = np.zeros(to - at)
                if memory is not None:
                    units = Units(data, offsets)
                    scores = machine.documents(summary(*machine.margins(units, memory.scores_of(units)), machine.offset))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, to - at).columns[: len(carry)], pa.array(scores)], names=[*carry, "score"]
                )

    return picked.mapInArrow(tidy(run), ", ".join([*kinds_of(picked, carry), "score double"]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, train(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )

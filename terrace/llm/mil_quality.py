"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage of the
whole text is encoded by ``FEATURES`` counts taken from its characters and words,
by its words themselves, each hashed with a sign to one of ``SLOTS`` sums, and
by a learned layer. Gated attention (a tanh branch times a sigmoid branch)
weighs the passages; the weighted sum of their encodings gives the document's
score. Only document labels are used: gradients reach passages through the
attention. Training runs on the driver, on at most ``MAX_TRAIN_DOCS`` labelled
documents chosen by a hash of the id, and of each on at most
``MAX_TRAIN_PASSAGES`` passages, evenly spaced; scoring runs in tasks, over
every passage of everything.

Inputs are the text alone. Labels of documents whose crc32(doc_id as text)
mod 5 is 0 are held out.

Defined cases: a null, empty or blank text is one passage of no words and gets
the score that the model gives it; rows are scored one by one, so repeated rows
and null ids change nothing (a null id is not held out); a null label is
no label; without usable labels every score is 0.5; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.words import Words, blank_bytes, chunks, kinds_of, lean, mix, pick_text, run_hash, tidy

PASSAGE = 64
SLOTS, CALM = 128, 4.0
MAX_TRAIN_DOCS, MAX_TRAIN_PASSAGES = 2000, 64
HIDDEN, GATE, EPOCHS, RATE, DECAY = 16, 8, 200, 0.02, 1e-4
CHUNK = 2 << 20
FEATURES = (
    "words", "chars_per_word", "upper", "symbols", "marks", "digits", "stops", "commas", "bars", "lines",
    "non_ascii", "same_as_last", "kinds", "seen_before", "runs_seen_before", "short_words", "long_words",
)
WIDTH = len(FEATURES) + SLOTS


def byte_sets() -> np.ndarray:
    """(sets, 256): which bytes each character feature counts."""
    sets = np.zeros((8, 256), bool)
    for i, chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#*$%&<>=_~^", b"!?", b"0123456789", b".", b",;:", b"|", b"\n")):
        sets[i, list(chars)] = True
    return sets


def word_sums(passage: np.ndarray, n_passages: int, word: np.ndarray) -> np.ndarray:
    """(passages, ``SLOTS``): signed counts of the hashed words over the root of the passage's length."""
    key = mix(word ^ np.uint64(0xA24BAED4963EE407))
    slot = passage * SLOTS + (key % np.uint64(SLOTS)).astype(np.int64)
    sign = np.where(key >> np.uint64(63), 1.0, -1.0)
    sums = np.bincount(slot, sign, n_passages * SLOTS).reshape(n_passages, SLOTS)
    return sums / np.sqrt(np.maximum(np.bincount(passage, minlength=n_passages), 1))[:, None]


def evenly(row: np.ndarray, most: int) -> np.ndarray:
    """Which passages stay when each row keeps at most ``most`` of them, evenly spaced; ``row`` ascends."""
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(row)))
    nth = np.arange(len(row)) - np.repeat(first, size)
    return nth * most % np.repeat(size, size) < most


def passage_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passages, counts and word sums) and the row of each passage; a row without words has one passage of zeros."""
    words = Words(data, offsets)
    n_rows = len(words.n_words)
    n_passages = np.maximum(1, -(-words.n_words // PASSAGE))
    row = np.repeat(np.arange(n_rows), n_passages)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_passages) - n_passages, n_passages)
    lo = words.first[row] + nth * PASSAGE
    hi = np.minimum(lo + PASSAGE, words.first[row + 1])
    count = hi - lo
    out = np.zeros((len(row), WIDTH), np.float32)
    n = len(words.starts)
    if not n:
        return out, row
    per_word = 1 / np.maximum(count, 1)

    def within(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[hi] - total[lo]

    full = count > 0
    from_byte = np.where(full, words.starts[np.minimum(lo, n - 1)], 0)
    to_byte = np.where(full, words.ends[np.maximum(hi - 1, 0)], 0)
    chars = np.maximum(to_byte - from_byte, 1)

    def bytes_within(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[to_byte] - total[from_byte]

    length = words.ends - words.starts
    doc = words.rows()
    out[:, 0] = count / PASSAGE
    out[:, 1] = bytes_within(~blank_bytes()[data]) * per_word / 8
    for i, flags in enumerate(byte_sets()):
        held = bytes_within(flags[data])
        out[:, 2 + i] = held / chars * 4 if i in (0, 3) else held * per_word
    out[:, 10] = bytes_within(data >= 128) / chars
    same = np.zeros(n, bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    out[:, 11] = within(same) * per_word
    passage = np.repeat(np.arange(len(row)), count)
    out[:, 12] = within(first_in(passage, words.hash)) * per_word
    out[:, 13] = within(~first_in(doc, words.hash)) * per_word
    runs = np.zeros(n, np.uint64)
    runs[: max(0, n - 2)] = run_hash(words.hash, 3)[: max(0, n - 2)]
    inside = np.arange(n) + 3 <= words.first[1:][doc]
    out[:, 14] = within(~first_in(doc, runs) & inside) * per_word
    out[:, 15] = within(length <= 3) * per_word
    out[:, 16] = within(length >= 15) * per_word
    out[:, len(FEATURES) :] = word_sums(passage, len(row), words.hash)
    return np.minimum(out, 4), row


def first_in(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether a position holds the first occurrence of its value in its group."""
    with np.errstate(over="ignore"):
        key = mix(value + group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    first = np.ones(len(key), bool)
    first[order[1:]] = key[order][1:] != key[order][:-1]
    return first


class Model:
    """Encoder, gated attention and scorer; parameters are plain arrays."""

    def __init__(self, n_features: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(n_features), np.ones(n_features)
        self.p = {
            "W": rng.normal(0, 0.3, (n_features, HIDDEN)) * min(1, (17 / n_features) ** 0.5),
            "b": np.zeros(HIDDEN),
            "V": rng.normal(0, 0.3, (HIDDEN, GATE)),
            "U": rng.normal(0, 0.3, (HIDDEN, GATE)),
            "w": rng.normal(0, 0.3, GATE),
            "c": rng.normal(0, 0.3, HIDDEN),
            "d": np.zeros(1),
        }

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        """``bounds``: first passage of each document; every document has one at least."""
        return self.forward_scaled((x - self.mean) / self.scale, bounds)

    def forward_scaled(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        sizes = np.diff(np.append(bounds, len(x)))
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, bounds), sizes))
        a /= np.repeat(np.add.reduceat(a, bounds), sizes)
        z = np.add.reduceat(a[:, None] * h, bounds)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "score": score, "sizes": sizes}

    def fit(self, x: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> None:
        """Adam on the mean log loss of the documents."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.scale[len(FEATURES) :] *= CALM  # many weak inputs beside few strong ones
        x = (x - self.mean) / self.scale
        p, m, v = self.p, {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}
        for step in range(1, EPOCHS + 1):
            f = self.forward_scaled(x, bounds)
            dz_out = (f["score"] - y) / len(y)
            dz = np.repeat(dz_out[:, None] * p["c"], f["sizes"], axis=0)
            a, h, t, g = f["a"][:, None], f["h"], f["t"], f["g"]
            da = (dz * h).sum(axis=1)
            mean_da = np.repeat(np.add.reduceat(f["a"] * da, bounds), f["sizes"])
            de = (f["a"] * (da - mean_da))[:, None]
            dt, dg = de * p["w"] * g * (1 - t * t), de * p["w"] * t * g * (1 - g)
            dh = (a * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
            grad = {
                "W": f["x"].T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg,
                "w": (de * t * g).sum(axis=0), "c": f["z"].T @ dz_out, "d": dz_out.sum(keepdims=True),
            }
            for k in p:
                d = grad[k] + DECAY * p[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)

    def score_rows(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, row = passage_features(data, offsets)
        if not len(x):
            return np.zeros(0)
        return self.forward(x, np.flatnonzero(np.append(True, row[1:] != row[:-1])))["score"]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS, max_passages: int = MAX_TRAIN_PASSAGES
) -> Model | None:
    """The model of at most ``max_docs`` labelled documents outside the held-out fold, of each at most
    ``max_passages`` passages; None without labels."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).where("doc_id is not null")
    sample = (
        usable.select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("__y"))
        .orderBy(F.xxhash64(F.lit(11), "__id"), "__id", "__y")
        .limit(max_docs)
        .groupBy("__id")
        .agg(F.max("__y").alias("__y"))
    )
    texts = lean(docs).select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text"))
    met = texts.join(F.broadcast(sample), "__id")  # at most max_docs rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(1), CHUNK):
                x, row = passage_features(data, offsets)
                some = evenly(row, max_passages)
                x, row = x[some], row[some]
                rows = batch.slice(at, to - at)
                bags = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * WIDTH), pa.array(x.ravel()))
                yield pa.record_batch(
                    [rows.column(0).take(pa.array(row)), rows.column(2).take(pa.array(row)), bags], names=["id", "y", "x"]
                )

    got = met.select("__id", "__text", "__y").mapInArrow(tidy(run), "id long, y int, x array<float>").toArrow()
    if not got.num_rows:
        return None
    ids, y = got["id"].to_numpy(), got["y"].to_numpy()
    x = np.array(got["x"].combine_chunks().flatten()).reshape(-1, WIDTH)
    order = np.lexsort(([crc32(passage.tobytes()) for passage in x], ids))  # the same order on every run
    ids, y, x = ids[order], y[order], x[order]
    bounds = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    model = Model(x.shape[1])
    model.fit(x, bounds, y[bounds].astype(float))
    return model


def score(docs: DataFrame, model: Model | None, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of every row, and ``score`` (0 to 1, higher: better)."""
    picked, text_at = pick_text(docs, carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(text_at), CHUNK):
                scores = np.full(to - at, 0.5) if model is None else model.score_rows(data, offsets)
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
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )

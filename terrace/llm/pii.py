"""Personal data in texts: fixed patterns, and a linear-chain CRF over word shapes.

Only words with a digit or an ``@``, or made of phone punctuation alone, can be
part of a span; they are found on the column's bytes, and runs of them are what
the patterns and the CRF read (no match can leave such a run). The CRF labels
the run's words (begin or inside of email, ip, card, phone, or none) from
their shapes and their neighbours' shapes, is trained on ``EXAMPLES`` by
gradient steps on the exact likelihood, and decodes batches of runs by Viterbi.
Words outside runs are always "none", so runs are decoded apart without loss.

Pattern spans always stay. A CRF span is added if it overlaps none of them and
holds what its kind needs (``valid``).

Defined cases: null and empty texts have no spans; rows are read one by one, so
repeated rows and null ids change nothing; an empty table gives none; a run
of any length is read whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.words import Words, chunks, kinds_of, pick_text, tidy

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# The labelled table; a span is written {kind words}.
EXAMPLES = """
call {phone +1 (212) 555-0100} now
tel {phone (212) 555-0100} or {phone (415) 555-0199}
phone: {phone 212-555-0100} ext 12
fax {phone 212.555.0100}, room 4
dial {phone +44 20 7946 0958} today
reach me on {phone 020 7946 0958} before 5
mobile {phone 06 12 34 56 78} chez nous
ring {phone 0049 30 901820} ab 9
numero {phone +34 912 345 678} por favor
{phone 555-867-5309} is my number
write to {email ann.lee@example.com} please
mail {email bob_99@mail.example.org}, or {email x+y@example.net}
contact <{email root@localhost}> at once
admin {email ops@intranet} 24 hours
paid with {card 4111 1111 1111 1111} on 3 May
card {card 5500-0000-0000-0004} exp 11/27
visa {card 4111111111111111} cvv 123
amex {card 3782 822463 10005} due
amex {card 371449635398431} gone
host {ip 10.0.0.1} is up
from {ip 192.168.1.17}:8080 to {ip 172.16.254.3}/24
server [{ip 203.0.113.9}] port 443
version 3.0.1 of 2024
release 2.10.4.1-beta on 2024-01-15
section 4.2.1 and 7.3
in 1999 and 2004 there were 12 of 300
price 12.50 or 1,299.00 or 99
at 10:30 or 23:59:59 on 2024-01-15
15/01/2024 and 01-02-2003 and 2003.04.05
pages 10-20 and 100-200
room 101 floor 3 row 12 seat 7
isbn 978-3-16-148410-0 and 0306406152
order 100023 item 55 lot 77881
id 20240229000012 and 99999999999999999999
token 04dbebab91ab85687d33eeaaf9ac699e1188f962 here
hash 9f86d081884c7d65 and 0xdeadbeef
@user said @other 5 times
model X100 and B52 and 3D
1st 2nd 3rd 20th
50% off 3 for 2 4x4
(1) (2) (3) and (12)
a - b ( c ) - 4
1 2 3 4 5 6 7 8 9 10
2 000 000 and 12 500 000
3.14159 and 2.71828 and -40
licensed under version 4.0. and 2.0.
"""
LABELS = ["none"] + [f"{b}-{k}" for k in KINDS for b in ("begin", "inside")]
EPOCHS, RATE, DECAY, HASHED = 250, 0.1, 2e-3, 1 << 10
CHUNK = 2 << 20
_RUN_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIM = re.compile(r"^[^A-Za-z0-9+(]+|[^A-Za-z0-9)]+$")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def fits(kind: str, text: str) -> bool:
    """What a match of a base pattern must hold besides."""
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def valid(kind: str, text: str) -> bool:
    """What a CRF span must hold."""
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 -]", text)
    if kind == "phone":
        return 8 <= len(digits) <= 15 and not re.search(r"[^0-9 ().+-]", text) and bool(re.search(r"[ ().-]", text))
    if kind == "ip":
        parts = text.split(":")[0].split("/")[0].split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and int(p) <= 255 for p in parts)
    return re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]*[A-Za-z0-9]", text) is not None


def shape(word: str) -> str:
    """Letters as a or A (runs once), digits as 9 with their number to 20, other characters as they are."""
    out = re.sub(r"[A-Z]+", "A", re.sub(r"[^\W\d_A-Z]+", "a", word))
    return re.sub(r"[0-9]+", lambda m: f"9{min(20, len(m.group()))}", out)


def features(words: list[str]) -> list[list[int]]:
    """Hashed features of each word: its shape, length class, edges, and its neighbours' shapes."""
    shapes = ["^", *map(shape, words), "$"]
    out = []
    for i, w in enumerate(words, 1):
        digits = sum(c.isdigit() for c in w)
        said = (
            f"s{shapes[i]}", f"k{re.sub('9[0-9]+', '9', shapes[i])}", f"d{digits}", f"f{w[0] if not w[0].isalpha() else 'a'}",
            f"p{shapes[i - 1]}", f"n{shapes[i + 1]}", f"b{shapes[i - 1]}|{shapes[i]}", f"a{shapes[i]}|{shapes[i + 1]}",
        )
        out.append([int.from_bytes(hashlib.blake2b(s.encode(), digest_size=4).digest(), "little") % HASHED for s in said])
    return out


def runs_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of the runs of words that can hold personal data."""
    out, last = [], None
    for m in _RUN_WORD.finditer(text):
        w = m.group()
        if re.search(r"[0-9@]", w) or not re.search(r"[^().+-]", w):
            if last == m.start():
                out[-1] = (out[-1][0], m.end())
            else:
                out.append((m.start(), m.end()))
            last = re.compile(r"[\x20\x09-\x0D]*").match(text, m.end()).end()
    return out


class Crf:
    """Weights of hashed features and of label pairs; runs begin and end in "none"."""

    def __init__(self):
        self.emit = np.zeros((HASHED, len(LABELS)))
        self.step = np.zeros((len(LABELS), len(LABELS)))
        # an inside label follows only begin or inside of its kind
        self.bar = np.zeros_like(self.step)
        for k in range(len(KINDS)):
            inside = 2 + 2 * k
            self.bar[:, inside] = -1e9
            self.bar[[inside - 1, inside], inside] = 0

    def padded(self, runs: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """(runs, longest, labels) scores and the runs' lengths."""
        sizes = np.array([len(r) for r in runs])
        flat = self.emit[np.array([f for r in runs for f in r])].sum(axis=1)
        out = np.zeros((len(runs), int(sizes.max()), len(LABELS)))
        at = np.arange(out.shape[1]) < sizes[:, None]
        out[at] = flat
        return out, sizes

    def viterbi(self, runs: list[list[list[int]]]) -> list[list[int]]:
        """Best labels of each run; runs of like length share a batch."""
        labels: list[list[int]] = [[] for _ in runs]
        order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and len(runs[order[hi]]) * (hi + 1 - lo) <= 200_000:
                hi += 1
            own = order[lo:hi]
            scores, sizes = self.padded([runs[i] for i in own])
            step, back = self.step + self.bar, np.zeros(scores.shape, np.int8)
            best = scores[:, 0] + step[0]
            for t in range(1, scores.shape[1]):
                paths = best[:, :, None] + step
                back[:, t] = paths.argmax(axis=1)
                going = (t < sizes)[:, None]
                best = np.where(going, paths.max(axis=1) + scores[:, t], best)
            last = (best + step[:, 0]).argmax(axis=1)
            for n, i in enumerate(own):
                path = [int(last[n])]
                for t in range(sizes[n] - 1, 0, -1):
                    path.append(int(back[n, t, path[-1]]))
                labels[i] = path[::-1]
            lo = hi
        return labels

    def gradient(self, runs, truth) -> tuple[np.ndarray, np.ndarray]:
        """Of the log likelihood (forward-backward per run)."""
        emit, step = np.zeros_like(self.emit), np.zeros_like(self.step)
        move = self.step + self.bar
        for run, labels in zip(runs, truth):
            s = self.emit[np.array(run)].sum(axis=1)
            n = len(s)
            ahead, behind = np.zeros_like(s), np.zeros_like(s)
            ahead[0] = move[0] + s[0]
            for t in range(1, n):
                ahead[t] = np.logaddexp.reduce(ahead[t - 1][:, None] + move, axis=0) + s[t]
            behind[-1] = move[:, 0]
            for t in range(n - 2, -1, -1):
                behind[t] = np.logaddexp.reduce(move + s[t + 1] + behind[t + 1], axis=1)
            total = np.logaddexp.reduce(ahead[-1] + behind[-1])
            node = -np.exp(ahead + behind - total)
            node[np.arange(n), labels] += 1
            for t, f in enumerate(run):
                np.add.at(emit, f, node[t])
            before, after = [0, *labels], [*labels, 0]
            np.add.at(step, (before, after), 1)
            step[0] -= np.exp(move[0] + s[0] + behind[0] - total)
            step[:, 0] -= np.exp(ahead[-1] + move[:, 0] - total)
            for t in range(1, n):
                step -= np.exp(ahead[t - 1][:, None] + move + s[t] + behind[t] - total)
        return emit, step

    def fit(self, table: str = EXAMPLES) -> Crf:
        runs, truth = [], []
        for line in table.strip().splitlines():
            text, marks = "", []
            for piece in re.split(r"(\{\w+ [^}]*\})", line):
                if m := re.fullmatch(r"\{(\w+) ([^}]*)\}", piece):
                    marks.append((m[1], len(text), len(text) + len(m[2])))
                    text += m[2]
                else:
                    text += piece
            for start, end in runs_of(text):
                words = [(start + m.start(), start + m.end()) for m in _RUN_WORD.finditer(text[start:end])]
                labels = []
                for a, b in words:
                    held = [(k, s) for k, s, e in marks if s < b and a < e]
                    labels.append(0 if not held else 1 + 2 * KINDS.index(held[0][0]) + (a > held[0][1]))
                runs.append(features([text[a:b] for a, b in words]))
                truth.append(labels)
        seen = [0.0, 0.0]
        for _ in range(EPOCHS):
            for i, (name, grad) in enumerate(zip(("emit", "step"), self.gradient(runs, truth))):
                now = getattr(self, name)
                grad = grad - DECAY * now * len(runs)
                seen[i] = seen[i] + grad * grad
                setattr(self, name, now + RATE * grad / (np.sqrt(seen[i]) + 1e-8) * 3)
        return self


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [
        (kind, m.start(), m.end())
        for kind in KINDS
        for m in PATTERNS[kind].finditer(text)
        if fits(kind, m.group())
    ]


def crf_spans(text: str, words: list[tuple[int, int]], labels: list[int]) -> list[tuple[str, int, int]]:
    out, i = [], 0
    while i < len(labels):
        if labels[i] % 2 == 0:
            i += 1
            continue
        j = i + 1
        while j < len(labels) and labels[j] == labels[i] + 1:
            j += 1
        kind = KINDS[labels[i] // 2]
        start, end = words[i][0], words[j - 1][1]
        lead = re.match(r"[^A-Za-z0-9+(]*", text[start:end]).end()
        tail = re.search(r"[^A-Za-z0-9)]*$", text[start:end]).start()
        if kind == "ip" and (m := re.match(r"[0-9.]+", text[start + lead : end])):
            tail = lead + m.end()
        start, end = start + lead, start + max(lead, tail)
        if valid(kind, text[start:end]):
            out.append((kind, start, end))
        i = j
    return out


def word_runs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of every run of words that can hold personal data."""
    data, n = words.data, len(words.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def count(chars: bytes) -> np.ndarray:
        flags = np.zeros(256, bool)
        flags[list(chars)] = True
        total = np.concatenate([[0], np.cumsum(flags[data], dtype=np.int32)])
        return total[words.ends] - total[words.starts]

    can = (count(b"0123456789@") > 0) | (count(b"().+-") == words.ends - words.starts)
    at = np.flatnonzero(can)
    row = words.rows()
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[at][1:] != row[at][:-1])
    heads = np.flatnonzero(new)
    return at[heads], at[np.append(heads[1:], len(at)) - 1] if len(at) else at


def find_all(data: np.ndarray, offsets: np.ndarray, crf: Crf) -> tuple[list[list], list[list]]:
    """Per row: base spans, and CRF spans that were added; (kind index, start, end) in code points."""
    words = Words(data, offsets, hashes=False)
    n_rows = len(offsets) - 1
    base: list[list] = [[] for _ in range(n_rows)]
    added: list[list] = [[] for _ in range(n_rows)]
    first, last = word_runs(words)
    if not len(first):
        return base, added
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)])
    row = words.rows()[first]
    shift = points[words.starts[first]] - points[offsets[row]]
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(words.starts[first], words.ends[last])]
    bounds = [[m.span() for m in _RUN_WORD.finditer(t)] for t in texts]
    labels = crf.viterbi([features([t[a:b] for a, b in w]) for t, w in zip(texts, bounds)])
    for t, w, l, r, s in zip(texts, bounds, labels, row.tolist(), shift.tolist()):
        sure = base_spans(t)
        base[r] += [(KINDS.index(k), s + a, s + b) for k, a, b in sure]
        for k, a, b in crf_spans(t, w, l):
            if not any(a < y and x < b for _, x, y in sure):
                added[r].append((KINDS.index(k), s + a, s + b))
    return base, added


def listed(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of every row, ``base_spans`` and ``spans`` (kind:start:end, comma-joined), ``counts`` of base spans."""
    crf = Crf().fit()
    picked, text_at = pick_text(docs, carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(text_at), CHUNK):
                base, added = find_all(data, offsets, crf)
                counts = [[sum(s[0] == k for s in b) for k in range(len(KINDS))] for b in base]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(at, to - at).columns[: len(carry)],
                        pa.array(list(map(listed, base)), pa.string()),
                        pa.array([listed(b + a) for b, a in zip(base, added)], pa.string()),
                        pa.array(counts, pa.list_(pa.int64())),
                    ],
                    names=[*carry, "base_spans", "spans", "counts"],
                )

    kinds = kinds_of(picked, carry)
    return picked.mapInArrow(tidy(run), ", ".join([*kinds, "base_spans string, spans string, counts array<long>"]))


def digest(docs: DataFrame) -> DataFrame:
    return find(docs, ["doc_id"]).select(
        "doc_id",
        *[F.col("counts")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )

"""Repetition rules from a suffix array over each whole text's words, beside plain counts.

Tasks take documents in runs of a few megabytes and build one suffix array
for the run by prefix doubling. First ranks hold the document, so suffixes of
different documents never tie, and only suffixes that still tie are sorted
again. The longest common prefix of neighbours comes from the ranks of each
doubling round. A suffix's deepest LCP interval is the larger of its two
neighbours' prefixes: the longest repeated substring that starts there. Those
of at least ``min_repeat`` words are spans; their union is the covered part.

A document is rejected by the method if the union covers more than
``max_covered`` of its words or if its longest repeat is over
``max_longest`` words.

Defined cases: a null, empty or blank text has no words and fails the base
rule; rows are judged one by one, so repeated rows and null ids change
nothing; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.words import Words, blank_bytes, chunks, kinds_of, pick_text, tidy

MIN_REPEAT, MAX_COVERED, MAX_LONGEST = 5, 0.4, 100
CHUNK = 1 << 20


def suffix_repeats(tokens: np.ndarray, doc: np.ndarray, doc_end: np.ndarray) -> np.ndarray:
    """For each position, the words of the longest substring that starts there and occurs again in its document.

    ``tokens``: hashes; ``doc``: row of each, ascending; ``doc_end``: end position of each one's row.
    """
    n = len(tokens)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    order = np.lexsort((tokens, doc))
    new = np.ones(n, bool)
    new[1:] = (tokens[order][1:] != tokens[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    heads = np.flatnonzero(new)
    rank = np.empty(n, np.int64)  # place of a suffix's group in the suffix array
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    rounds, width = [rank.astype(np.int32)], 1
    active = order[np.repeat(np.diff(np.append(heads, n)) > 1, np.diff(np.append(heads, n)))]
    while len(active):
        ahead = active + width
        inside = ahead < doc_end[active]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.lexsort((second, rank[active]))
        active, first, second = active[by], rank[active][by], second[by]
        group = np.ones(len(active), bool)
        group[1:] = first[1:] != first[:-1]
        part = group.copy()
        part[1:] |= second[1:] != second[:-1]
        at = np.arange(len(active))
        group_at = np.maximum.accumulate(np.where(group, at, 0))
        part_at = np.maximum.accumulate(np.where(part, at, 0))
        rank[active] = first + (part_at - group_at)
        heads = np.flatnonzero(part)
        sizes = np.diff(np.append(heads, len(active)))
        width *= 2
        active = active[np.repeat(sizes > 1, sizes)]
        if len(active):
            rounds.append(rank.astype(np.int32))
    array = np.argsort(rank, kind="stable")
    left, right = array[:-1], array[1:]
    pair = np.flatnonzero(rounds[0][left] == rounds[0][right])
    left, right = left[pair], right[pair]
    common = np.zeros(len(pair), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        inside = right + common < doc_end[right]
        inside &= left + common < doc_end[left]
        same = inside & (
            rounds[k][np.minimum(left + common, n - 1)] == rounds[k][np.minimum(right + common, n - 1)]
        )
        common[same] += 1 << k
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Positions in the union of the repeats of at least ``least`` words."""
    n = len(longest)
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(longest >= least)
    edge[at] += 1
    np.subtract.at(edge, at + longest[at], 1)
    return np.cumsum(edge[:-1]) > 0


def per_row(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def measures(data: np.ndarray, offsets: np.ndarray, min_repeat: int) -> dict[str, np.ndarray]:
    """The counts of a run of texts, a value per row."""
    words = Words(data, offsets)
    n = len(offsets) - 1
    solid = ~blank_bytes()[data]
    symbol = np.zeros(256, bool)
    symbol[list(b"#*$%&|<>")] = True
    doc = words.rows()
    longest = suffix_repeats(words.hash, doc, words.first[1:][doc])
    dup = np.zeros(n, np.int64)
    raw = data.tobytes()
    for i in range(n):
        lines = [x for x in raw[offsets[i] : offsets[i + 1]].split(b"\n") if x.strip()]
        dup[i] = len(lines) - len(set(lines))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, doc, longest)
    return {
        "n_words": words.n_words.astype(np.int64),
        "word_chars": per_row(solid & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_row(symbol[data], offsets),
        "n_dup_lines": dup,
        "n_repeat_words": per_row(covered(longest, 3), words.first),
        "n_covered": per_row(covered(longest, min_repeat), words.first),
        "longest_repeat": most,
    }


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]


def score(docs: DataFrame, carry: list[str], min_repeat: int = MIN_REPEAT) -> DataFrame:
    """The columns ``carry`` of every row, and its counts in columns ``__<count>``."""

    picked, text_at = pick_text(docs, carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(text_at), CHUNK):
                found = measures(data, offsets, min_repeat)
                rows = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[: len(carry)], *[pa.array(found[c]) for c in COUNTS]],
                    names=[*carry, *[f"__{c}" for c in COUNTS]],
                )

    return picked.mapInArrow(tidy(run), ", ".join([*kinds_of(picked, carry), *[f"`__{c}` long" for c in COUNTS]]))


def verdicts(scored: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """``scored`` plus booleans ``__base_failed`` and ``__kept``."""
    n = F.col("__n_words")
    failed = (n < 50) | (100 * F.col("__n_repeat_words") > 50 * n)
    repeats = (F.col("__n_covered") > max_covered * n) | (F.col("__longest_repeat") > max_longest)
    return scored.withColumns({"__base_failed": failed, "__kept": ~failed & ~repeats})


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, columns unchanged."""
    return verdicts(score(docs, docs.columns)).where("__kept").select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    judged = verdicts(score(docs, ["doc_id"]))
    return judged.select(
        "doc_id",
        *[F.col(f"__{c}").alias(c) for c in COUNTS[:5]],
        F.col("__base_failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
        F.col("__n_covered").alias("n_covered"),
        (F.col("__longest_repeat") > MAX_LONGEST).alias("long_repeat"),
    )


#: Windows instead of suffixes: a position is covered if a repeated window of the least length covers it.
DIGEST_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i, len(w) AS n FROM docs
), grams AS (
  SELECT doc_id, i, n,
         string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS g3,
         string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS g5,
         md5(string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 100 FOLLOWING)) AS g101
  FROM words
), counted AS (
  SELECT doc_id, i, n,
         count(*) FILTER (WHERE i + 2 <= n) OVER (PARTITION BY doc_id, i + 2 <= n, g3) AS c3,
         count(*) FILTER (WHERE i + 4 <= n) OVER (PARTITION BY doc_id, i + 4 <= n, g5) AS c5,
         count(*) FILTER (WHERE i + 100 <= n) OVER (PARTITION BY doc_id, i + 100 <= n, g101) AS c101
  FROM grams
), cover AS (
  SELECT doc_id,
         max(c3) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) > 1 AS in3,
         max(c5) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) > 1 AS in5,
         c101 > 1 AS long
  FROM counted
), per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE in3) AS n_repeat_words, count(*) FILTER (WHERE in5) AS n_covered,
         bool_or(long) AS long_repeat
  FROM cover GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(n_covered, 0) AS BIGINT) AS n_covered, coalesce(long_repeat, false) AS long_repeat
  FROM docs LEFT JOIN per_doc USING (doc_id) LEFT JOIN dup USING (doc_id)
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_covered > 0.4 * n_words OR long_repeat) AS kept, n_covered, long_repeat
FROM failed
"""

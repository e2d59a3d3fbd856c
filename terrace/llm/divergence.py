"""Source divergence audit: how each source's terms depart from its language's and from every other source's.

Terms are runs of letters (A-Z, a-z and everything from U+0080 on) with A-Z
lower-cased. Tasks count them per (lang, source) by length-bucketed packing
(``packed``): short terms as one or two uint64, radix-sorted and run-counted,
long terms in byte-sorted buckets of their own. Spark adds the counts up. A
language keeps the terms that at least ``MIN_DOCS`` of its rows hold.

With V kept terms and N their occurrences in a group, a term of ``n``
occurrences has p = 1 + floor(1e9 * (n + 1) / (N + V)), and the divergence of p
from q is floor((p - q)^2 / q). All of it is integer arithmetic in 64 bits: the
division is done by thousands, so nothing overflows below 9e15 occurrences.

Pairs of sources: the sum over all kept terms is split. Terms that neither
source holds add one constant each; terms of one source against the other's
p of an absent term need only the source's histogram of counts; what remains
are terms that both hold, and those are added up in numpy over rows sorted by
term, one sum for each pair and task. No row is made for a pair of sources and
a term, and no histogram meets more than the distinct absent-term values.

Defined cases: null text, lang or source read as ''; a group without kept
terms (or without any text) still meets the others, by absent terms alone; a
language with no kept terms has value 0 for all pairs and no term rows;
repeated rows count each; an empty table gives none; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.packed import count_runs, lowered, spans, strings
from terrace.llm.tables import row_numbers, stored
from terrace.llm.words import chunks, lean, tidy

MIN_DOCS = 3
TOP = 200
CHUNK = 16 << 20
#: Pair sums held by a task before it emits them.
PAIRS = 1 << 20


def term_bytes() -> np.ndarray:
    solid = np.zeros(256, bool)
    solid[65:91] = solid[97:123] = solid[128:] = True
    return solid


def text_or_blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, rows): occurrences of each term in each group, and the rows that hold it; stored."""
    solid = term_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, source = (batch.column(i).dictionary_encode() for i in (0, 1))
            wide = max(1, len(source.dictionary))
            group = (np.asarray(lang.indices).astype(np.uint32) * np.uint32(wide)) + np.asarray(source.indices).astype(np.uint32)
            for at, to, data, offsets in chunks(batch.column(2), CHUNK):
                data = lowered(data)
                starts, lengths, row = spans(solid[data], offsets)
                runs = count_runs(data, starts, lengths, group[at:to][row], row)
                which = runs.group.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        lang.dictionary.take(pa.array(which // wide)),
                        source.dictionary.take(pa.array(which % wide)),
                        strings(data, runs.start, runs.length),
                        pa.array(runs.count, pa.int64()),
                        pa.array(runs.rows, pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "rows"],
                )

    read = lean(docs).select(
        text_or_blank("lang").alias("lang"), text_or_blank("source").alias("source"), text_or_blank("text").alias("text")
    )
    found = read.mapInArrow(tidy(run), "lang string, source string, term string, n long, rows long")
    return stored(
        found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")), "divergence-counts"
    )


def share(n: Column, total: Column) -> Column:
    """1 + floor(1e9 * (n + 1) / total), exact: the quotient by thousands."""
    quotient, rest = _div(n + 1, total), (n + 1) % total
    for _ in range(3):
        quotient, rest = quotient * 1000 + _div(rest * 1000, total), (rest * 1000) % total
    return quotient + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def departure(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q), for whole numbers up to 1e9 + 1."""
    return _div((p - q) * (p - q), q)


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``counts`` of the terms that enough rows of their lang hold, with the lang's ``n_lang``; stored.

    ``first`` marks one row of each (lang, term). A window holds a row for each source of the term.
    """
    term = Window.partitionBy("lang", "term")
    first = F.row_number().over(term.orderBy("source")) == 1
    return stored(
        counts.withColumn("first", first)
        .withColumn("n_lang", F.sum("n").over(term))
        .withColumn("held", F.sum("rows").over(term))
        .where(F.col("held") >= min_docs)
        .select("lang", "source", "term", "n", "n_lang", "first"),
        "divergence-kept",
    )


class Audit:
    """The counted tables that both parts read."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        self.kept = kept_terms(count_terms(docs), min_docs)
        self.histogram = stored(  # of each group: how many terms occur n times
            self.kept.groupBy("lang", "source", "n").agg(
                F.count("*").alias("terms"), F.sum(F.col("first").cast("long")).alias("firsts")
            ),
            "divergence-histogram",
        )
        totals = self.histogram.groupBy("lang", "source").agg(
            F.sum(F.col("n") * F.col("terms")).alias("total"), F.sum("terms").alias("terms"), F.sum("firsts").alias("firsts")
        )
        present = docs.select(text_or_blank("lang").alias("lang"), text_or_blank("source").alias("source")).distinct()
        known = stored(present.join(totals, ["lang", "source"], "left").na.fill(0), "divergence-totals")
        langs = known.groupBy("lang").agg(F.sum("firsts").alias("V"), F.sum("total").alias("lang_total"))
        groups, self.n_groups = row_numbers(
            known.select("lang", "source", "total", "terms"), [F.col("lang"), F.col("source")], "divergence-groups"
        )
        size = F.col("total") + F.col("V")
        self.groups = stored(  # one row a group; absent: its p of a term that it lacks
            groups.join(langs, "lang").select(
                "lang",
                "source",
                F.col("__row").alias("id"),
                "terms",
                "V",
                size.alias("size"),
                (F.col("lang_total") + F.col("V")).alias("lang_size"),
                F.when(F.col("V") > 0, share(F.lit(0).cast("long"), size)).alias("absent"),
            ),
            "divergence-sizes",
        )

    def term_part(self, top: int = TOP) -> DataFrame:
        """Terms above their lang's share, the ``top`` of each group.

        The rank limit is applied in every task before the rows of a group meet.
        """
        p, q = share(F.col("n"), F.col("size")), share(F.col("n_lang"), F.col("lang_size"))
        over = (
            self.kept.join(self.groups.select("lang", "source", "size", "lang_size"), ["lang", "source"])
            .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
            .where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), "item", departure(F.col("p"), F.col("q")).alias("value"))
        )
        return ranked(over).where(F.col("rank") <= top)

    def pair_part(self) -> DataFrame:
        """Every other source of the same lang, with the divergence from it over all kept terms."""
        groups = self.groups
        shares = self.histogram.join(groups.select("lang", "source", "id", "size"), ["lang", "source"]).select(
            "lang", "id", "terms", share(F.col("n"), F.col("size")).alias("p")
        )
        absents = groups.where("V > 0").select("lang", F.col("absent").alias("q")).distinct()
        against = stored(
            shares.join(absents, "lang")
            .groupBy("id", "q")
            .agg(
                F.sum(F.col("terms") * departure(F.col("p"), F.col("q"))).alias("from_q"),
                F.sum(F.col("terms") * departure(F.col("q"), F.col("p"))).alias("to_q"),
            ),
            "divergence-against",
        )
        a = groups.select("lang", "source", F.col("id").alias("a"), F.col("absent").alias("absent_a"), F.col("terms").alias("terms_a"), "V")
        b = groups.select("lang", F.col("source").alias("item"), F.col("id").alias("b"), F.col("absent").alias("absent_b"), F.col("terms").alias("terms_b"))
        pairs = (
            a.join(b, "lang")  # one row for each pair of sources: the result's own size
            .where("a <> b")
            .join(against.select(F.col("id").alias("a"), F.col("q").alias("absent_b"), "from_q"), ["a", "absent_b"], "left")
            .join(against.select(F.col("id").alias("b"), F.col("q").alias("absent_a"), "to_q"), ["b", "absent_a"], "left")
            .join(self.shared_terms(), ["a", "b"], "left")
        )
        neither = (F.col("V") - F.col("terms_a") - F.col("terms_b")) * departure(F.col("absent_a"), F.col("absent_b"))
        none = F.lit(0).cast("long")
        value = sum((F.coalesce(F.col(c), none) for c in ("from_q", "to_q", "both")), F.coalesce(neither, none))
        return ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")))

    def shared_terms(self) -> DataFrame:
        """(a, b, both): over terms that both hold, what their divergence adds to what the other sums say of them."""
        rows = (
            self.kept.join(self.groups.select("lang", "source", "id", "size", "absent"), ["lang", "source"])
            .repartition("lang", "term")
            .sortWithinPartitions("lang", "term", F.col("first").desc())
            .select("first", "id", share(F.col("n"), F.col("size")).alias("p"), "absent")
        )
        part = rows.mapInArrow(tidy(pair_sums(self.n_groups)), "a long, b long, both long")
        return part.groupBy("a", "b").agg(F.sum("both").alias("both"))


def pair_sums(n_groups: int):
    """mapInArrow over (first, id, p, absent) sorted by term: one sum for each ordered pair of groups."""

    def f(p, q):
        return (p - q) * (p - q) // q

    def sums(cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        first, group, p, absent = cols
        codes, values = [], []
        edges = np.append(np.flatnonzero(first), len(first))
        left = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(first))
        at, d = np.flatnonzero(left > 1), 1
        while len(at):
            for x, y in ((at, at + d), (at + d, at)):
                codes.append(group[x] * n_groups + group[y])
                values.append(f(p[x], p[y]) - f(p[x], absent[y]) - f(absent[x], p[y]) + f(absent[x], absent[y]))
            d += 1
            at = at[left[at] > d]
        return added(np.concatenate(codes), np.concatenate(values)) if codes else (np.zeros(0, np.int64),) * 2

    def added(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kinds, which = np.unique(codes, return_inverse=True)
        out = np.zeros(len(kinds), np.int64)
        np.add.at(out, which, values)
        return kinds, out

    def emitted(codes: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(codes // n_groups), pa.array(codes % n_groups), pa.array(values)], names=["a", "b", "both"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            cut = int(np.flatnonzero(cols[0])[-1])  # the last term may go on in the next batch
            held = [c[cut:] for c in cols]
            more = sums([c[:cut] for c in cols])
            total = added(np.concatenate([total[0], more[0]]), np.concatenate([total[1], more[1]]))
            if len(total[0]) > PAIRS:
                yield emitted(*total)
                total = (total[0][:0], total[1][:0])
        if held is not None:
            more = sums(held)
            total = added(np.concatenate([total[0], more[0]]), np.concatenate([total[1], more[1]]))
        yield emitted(*total)

    return run


def ranked(rows: DataFrame) -> DataFrame:
    """``rank`` from 1 within (lang, source, part), by value downwards, then item by its bytes."""
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def digest(docs: DataFrame) -> DataFrame:
    audit = Audit(docs)
    return audit.pair_part().unionByName(audit.term_part())


DIGEST_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
occ AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[a-z\x{80}-\x{10FFFF}]+')) AS term FROM docs
),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n_lang FROM occ GROUP BY ALL HAVING count(DISTINCT id) >= 3
),
counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM occ JOIN kept USING (lang, term) GROUP BY ALL
),
groups AS (SELECT DISTINCT lang, source FROM docs),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n_lang)::HUGEINT AS total FROM kept GROUP BY lang),
totals AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL
),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p,
         1 + (1000000000 * (k.n_lang + 1)) // (l.total + l.v) AS q
  FROM totals g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM rows
) WHERE part = 'pair' OR rank <= 200
"""

"""URL verdicts: host and path rules first, then an exact block list held in a Bloom filter cascade.

The cascade covers the corpus's complete key universe (every host that
occurs). Level 1 is a Bloom filter of the listed keys; level 2 one of the
unlisted keys that pass level 1; level 3 one of the listed keys that pass
level 2; and so on until a level lets no wrong key through. Every key of the
universe then has an exact answer, which pages get by looking bits up: no join.

A level is one array of 64-bit words, sized from the number of its keys
(``BITS_PER_KEY``). Keys are split by hash into so many groups that no level
passes ``MAX_LEVEL_WORDS``; a group has a cascade of its own, and pages are read
once, each asking its own group's. Only the words travel, never the keys.

The block list is a table of keys, of any size: it is united with the corpus's keys in
one aggregate, and only listed keys that occur go into the cascade.

Built-in functions only. Defined cases: a null url, or one without ``://``,
has empty host and path and is judged like any unlisted host; repeated rows
each get a verdict; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import stored

HASHES = 8
BITS_PER_KEY = 12  # with 8 hashes: about one wrong key in 300
MAX_LEVEL_WORDS = 8_000_000  # 64 MB


@dataclass
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def with_host_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` plus ``host`` (A-Z lower-cased) and ``path``; both empty where there is no ``://``."""
    whole = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rest = F.regexp_extract(whole, r"(?s)^.*?://(.*)$", 1)
    upper = "".join(map(chr, range(65, 91)))
    return pages.withColumn("__rest", rest).withColumns(
        {
            "host": F.translate(F.regexp_extract("__rest", r"^[^/?#]*", 0), upper, upper.lower()),
            "path": F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1),
        }
    ).drop("__rest")


def rule_of(rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits ``host`` and ``path`` (null if none)."""
    host, path = F.col("host"), F.col("path")
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is asked first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


@dataclass
class Level:
    words: DataFrame  # one row, one array of longs
    bits: int
    number: int

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(j)), F.lit(self.bits)) for j in range(HASHES)]

    def holds(self, key: Column) -> Column:
        words = self.words.scalar()
        return reduce(
            lambda a, b: a & b,
            [
                F.getbit(F.element_at(words, (F.shiftright(p, 6) + 1).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
                for p in self.places(key)
            ],
        )


def filter_words(keys: DataFrame, level: Level, n_words: int) -> DataFrame:
    """One row: the level's bits as an array of longs."""
    spark = keys.sparkSession
    ones = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("p")).select(
        F.shiftright("p", 6).alias("at"),
        F.expr("shiftleft(1L, cast(p & 63 as int))").alias("word"),
    )
    zeros = spark.range(n_words).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word"))
    merged = ones.union(zeros).groupBy("at").agg(F.bit_or("word").alias("word"))
    return merged.agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w")).select(
        F.expr("transform(w, x -> x.word)").alias("words")
    )


class Cascade:
    """Exact membership over the universe that it was built from."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.holds(key), answer).otherwise(F.lit(level.number % 2 == 0))
        return answer


def build(universe: DataFrame, max_levels: int = 64) -> Cascade:
    """The cascade of ``universe`` (key, listed), keys distinct; one counting and one building job a level."""
    levels: list[Level] = []
    for number in range(1, max_levels + 1):
        wrong = universe.where(F.col("listed") == F.lit(number % 2 == 1))
        for level in levels:
            wrong = wrong.where(level.holds(F.col("key")))
        n = wrong.count()
        if n == 0:
            return Cascade(levels)
        n_words = math.ceil(n * BITS_PER_KEY / 64)
        level = Level(universe, n_words * 64, number)
        level.words = stored(filter_words(wrong, level, n_words), f"cascade-{number}")
        levels.append(level)
    raise RuntimeError(f"the cascade did not close in {max_levels} levels")


def with_listing(rows: DataFrame, universe: DataFrame, key: str, max_words: int = MAX_LEVEL_WORDS) -> DataFrame:
    """``rows`` plus boolean ``listed``. ``universe``: (key, listed), distinct, with every key of ``rows``."""
    universe = stored(universe, "url-universe")
    n_keys = universe.agg(F.count("*")).first()[0]
    groups = max(1, math.ceil(n_keys * BITS_PER_KEY / 64 / max_words))  # no level holds more than all keys
    if groups == 1:
        return rows.withColumn("listed", build(universe).listed(F.col(key)))
    group_of = lambda c: F.pmod(F.xxhash64(F.lit(groups), c), F.lit(groups))
    listed = F.lit(None).cast("boolean")
    for g in range(groups):
        cascade = build(stored(universe.where(group_of(F.col("key")) == g), f"url-universe-{g}"))
        listed = F.when(group_of(F.col(key)) == g, cascade.listed(F.col(key))).otherwise(listed)
    return rows.withColumn("listed", listed)


def universe_of(keys: DataFrame, listed_keys: DataFrame) -> DataFrame:
    """(key, listed): the distinct keys of ``keys``, and whether ``listed_keys`` has them; first columns count. No join."""
    corpus = keys.select(F.col(keys.columns[0]).alias("key"), F.lit(True).alias("occurs"), F.lit(False).alias("listed"))
    listing = listed_keys.select(
        F.col(listed_keys.columns[0]).cast("string").alias("key"), F.lit(False).alias("occurs"), F.lit(True).alias("listed")
    )
    both = corpus.union(listing).groupBy("key").agg(F.bool_or("occurs").alias("occurs"), F.bool_or("listed").alias("listed"))
    return both.where("occurs").drop("occurs")


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame | Column, max_words: int = MAX_LEVEL_WORDS) -> DataFrame:
    """``pages`` plus host, path, rule, verdict.

    ``listed``: the block list, a table whose first column holds hosts (nulls and
    repeats are no harm), or a condition on ``host``.
    """
    placed = with_host_path(pages)
    hosts = placed.select("host")
    if isinstance(listed, DataFrame):
        universe = universe_of(hosts, listed)
    else:
        universe = hosts.distinct().select(F.col("host").alias("key"), listed.alias("listed"))
    name, verdict = rule_of(rules)
    return (
        with_listing(placed, universe, "host", max_words)
        .withColumns({"rule": name, "__verdict": verdict})
        .withColumn("verdict", F.coalesce("__verdict", F.when(F.col("listed"), "block").otherwise("allow")))
        .drop("__verdict", "listed")
    )


RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]
#: Host labels that the query's block list is drawn up by.
LISTED_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def block_list(pages: DataFrame) -> DataFrame:
    """The query's table of listed keys: whole hosts that carry one of ``LISTED_LABELS``."""
    hosts = with_host_path(pages).select("host").distinct()
    return hosts.where(F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, LISTED_LABELS))))


def digest(pages: DataFrame) -> DataFrame:
    listed = stored(block_list(pages), "url-list")
    return judge(pages.select("page_id", "url"), RULES, listed).select("page_id", "host", "path", "rule", "verdict")


DIGEST_SQL = r"""
WITH cut AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages
), placed AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM placed
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN list_has_any(string_split(host, '.'),
         ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

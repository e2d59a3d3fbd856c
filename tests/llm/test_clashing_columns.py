"""Tables with more columns than documents have, named like the operators' own."""

import random

from pyspark.sql import functions as F

from terrace.llm import chat, mil_quality, pii, quality_rules, suffix_dedup, urls
from tests.llm.conftest import odd_rows, prose

NAMES = (
    "id", "score", "spans", "counts", "row", "n", "key", "part", "start", "end", "lo", "hi", "hash", "fp", "node", "label", "y", "x",
    "held_out", "predicted", "kept", "n_words", "partners", "word", "rank", "size", "host", "path", "rule", "verdict", "__text", "__id",
)


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in NAMES if c not in df.columns})


def same(plain, more):
    assert plain.columns == more.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, more.collect()))


def test_documents(make_docs, spark):
    rng = random.Random(31)
    shared = prose(rng, 80)
    docs = make_docs(odd_rows(rng) + [(20 + i, f"{prose(rng, 30)} {shared} mail a.b@c.org") for i in range(6)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    same(suffix_dedup.digest(docs), suffix_dedup.digest(clashing(docs)))
    same(quality_rules.digest(docs), quality_rules.digest(clashing(docs)))
    same(pii.digest(docs), pii.digest(clashing(docs)))
    same(mil_quality.digest(docs, labels), mil_quality.digest(clashing(docs), clashing(labels)))


def test_pages_and_a_very_long_url(spark):
    rows = [(1, "http://a.example.net/en/x"), (2, None), (3, "no scheme"), (4, "https://www.example.com/de/"), (5, "http://" + "a." * 40_000 + "org/fr/" + "b" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    same(urls.digest(pages), urls.digest(clashing(pages).withColumn("html", F.lit("<p>"))))
    got = {r.page_id: (r.rule, r.verdict) for r in urls.digest(pages).collect()}
    assert got[1] == ("example.net/en/", "allow") and got[4] == ("example.com/de/", "block") and got[5] == ("org/fr/", "allow")


def test_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<s> yes"), (2, 0, "user", None), (None, 0, "user", "x")]
    talks = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    more = talks.withColumns({c: F.lit("clash") for c in (*NAMES, "n_turns", "loss_chars", "turns_sha256", "formatted_chars", "parts")})
    same(chat.digest(talks), chat.digest(more))

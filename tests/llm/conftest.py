import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source) tuples."""

    def make(rows):
        return spark.createDataFrame(
            [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOCS
        )

    return make


def prose(rng, n, vocabulary=400):
    """``n`` words with a long tail."""
    return " ".join(f"w{min(int(rng.paretovariate(0.7)), vocabulary)}x{rng.randrange(7)}" for _ in range(n))


#: Rows that every operator must take: nulls, empty, blank, one word, repeated rows, a very long text, an odd id.
def odd_rows(rng):
    long = prose(rng, 30_000)
    return [
        (1, None), (2, ""), (3, " \t\r\n "), (4, "one"), (5, "two words"), (6, long), (7, "é ü\nß"),
        (None, "no id at all " * 30), (None, None), (8, prose(rng, 60)), (8, prose(rng, 60)), (9, "same row"), (9, "same row"),
    ]

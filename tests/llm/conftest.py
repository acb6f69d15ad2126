import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, name string"


def invented(n, seed=0, words=400):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(words)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 220))) for _ in range(n)]


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text[, source]) rows as a documents table with extra columns of clashing names."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, None, "x") for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(partitions) if full else spark.createDataFrame([], DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(invented(60, seed=3, words=5000)) + " end"
    return [(1, None, None), (2, "", "b"), (3, "  \t\n ", "b"), (4, "one", "a"), (5, "one", "a"), (5, "one", "a"), (5, "other words here", "a"), (None, "one", None), (None, "alone without id", "c"), (7, long, "c"), (8, long + "!", "c"), (9, long, "a"), (10, "é\U0001f600 ñ " * 50, "a")]

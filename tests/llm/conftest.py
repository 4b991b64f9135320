import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text[, lang, source]) rows."""

    def make(rows, partitions=3):
        full = [(*r, *(["en", "src0"][len(r) - 2 :]), None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


@pytest.fixture
def awkward(spark):
    """Extra columns whose names the operators could use themselves, with NULLs, empty texts and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "one two  three", "en", "a", 5, "x", None, 1.0),
        (1, "one two  three", "en", "a", 5, "x", None, 1.0),
        (1, "one two\tthree", "en", "a", 5, "y", None, 1.0),
        (2, "one two three", "en", None, 5, "x", None, 2.0),
        (3, None, None, None, None, None, None, None),
        (3, None, None, None, None, None, None, None),
        (4, "", "de", "b", 0, "", None, 0.0),
        (5, " \n\t ", "de", "b", 0, "", None, 0.0),
        (None, "one two three", "en", "a", 5, "x", None, 1.0),
        (None, None, None, None, None, None, None, None),
        (6, long, "fr", "c", 5, "x", None, 1.0),
        (7, long, "fr", "c", 5, "x", None, 1.0),
        (8, "1234 !!!", "fr", "c", 5, "x", None, 1.0),
    ]
    columns = "doc_id long, text string, lang string, source string, size int, mark string, kept string, _mark double"
    return spark.createDataFrame(rows, columns)


@pytest.fixture
def words():
    def make(seed, n, vocabulary=3000):
        rng = random.Random(seed)
        return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]

    return make

import random

import pytest

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, _row string, _score int, size int, shard int, _print int, _mix_place string, tokens int"


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def row(doc_id, text, lang="en", source="src1"):
    return (doc_id, text, lang, source, None if text is None else len(text), True, "x", 1, 2, 3, 4, "p", 5)


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows and columns with clashing names."""
    long = words(1, 60_000)
    return [
        row(1, "alpha beta gamma delta"),
        row(2, "alpha beta gamma delta", None, None),
        row(3, None),
        row(4, ""),
        row(5, long, "de", "src0"),
        row(6, long, "fr", "src0"),
        row(7, words(2, 300)),
        row(7, words(2, 300)),
        row(7, words(3, 300)),
        row(None, words(4, 40)),
        row(None, words(4, 40)),
        row(8, " \t\n "),
        row(9, "Été ñandú 東京 😀 " * 30, "es", "odd source"),
        row(10, words(2, 299) + " changed"),
        row(11, "x"),
        row(12, "ALPHA beta GAMMA delta"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")

from pathlib import Path

import pytest

REPO = str(Path(__file__).resolve().parents[2])

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))

#: Nulls in every column, empty and blank texts, a very long one, ties and a repeated row; the extra columns have names that operators use inside.
ODD_ROWS = [
    (1, "a b c d e f g", "en", "s", 1, 9, "x"),
    (2, "a b c d e f g", "en", "s", 1, 9, "x"),
    (2, "a b c d e f g", "en", "s", 1, 9, "x"),
    (3, "", "en", None, 0, 9, "x"),
    (4, None, None, None, None, None, None),
    (5, " \t\r\n", "de", "s", 4, 9, "x"),
    (6, LONG, "de", "t", len(LONG), 9, "x"),
    (7, LONG + " tail", "de", "t", len(LONG), 9, "x"),
    (8, "é" * 5000, None, "t", 5000, 9, "x"),
    (None, "no id at all here", "en", "s", 3, 9, "x"),
    (9, "<|endoftext|> 'S ﬁ İ 中文 x", "en", "s", 3, 9, "x"),
]
ODD_TYPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, n int, key string"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_library(spark):
    spark.sparkContext.environment["PYTHONPATH"] = REPO


@pytest.fixture
def odd(spark):
    docs = spark.createDataFrame(ODD_ROWS, ODD_TYPE)
    return docs.selectExpr("*", "key as id", "key as body", "key as rep", "n as size", "key as host", "key as label", "n as toxic")


@pytest.fixture
def empty(odd):
    return odd.where("false")


@pytest.fixture
def texts(spark):
    """Documents of the given texts, numbered from 0."""

    def make(found, first=0):
        return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(found, first)], "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return make

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

WORDS = "red green blue stone river cloud iron paper glass seven".split()
PARAGRAPH = " ".join(WORDS * 6)
#: Nulls, empty and blank texts, a long text, ties, repeated rows, clashing column names.
ODD_ROWS = [
    (1, PARAGRAPH + "\nfirst own line", "en", "a", 3, "x", 0.5),
    (2, PARAGRAPH + "\nsecond own line", "en", "a", None, "x", 0.5),
    (2, PARAGRAPH + "\nsecond own line", "en", "a", None, "x", 0.5),
    (3, None, None, None, 0, None, None),
    (4, "", "de", "b", 0, "y", None),
    (5, " \n\t\n", "de", None, 3, "y", 1.0),
    (None, "a text without an id", "fr", "b", 20, "z", 1.0),
    (7, "word " * 60_000, "en", "a", 300_000, "z", 2.0),
    (8, "ab" * 100_000, "en", "a", 200_000, "z", 2.0),
    (9, "é ß 中文 😀 ́", None, "b", 9, "z", 2.0),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, score double"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(n, n % 2, n % 2) for n in (1, 2, 3, 4)] + [(5, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def small_folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_texts(spark, small_folder):
    return {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{small_folder}/documents.parquet").collect()}

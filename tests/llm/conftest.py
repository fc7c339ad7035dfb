import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from accessgrid.llm import ready

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fold string, key string"


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return ready(spark)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with internal names."""
    long = " ".join(f"word{n % 977}" for n in range(30_000)) + "\n" + "x" * 20_000
    rows = [
        (1, None, "en", "a", 0, "f", "k"),
        (2, "", "en", "a", 0, None, None),
        (None, "one two three\nfour", None, None, None, "f", "k"),
        (3, long, "en", "b", 5, "f", "k"),
        (4, "one two three\nfour", "xx", "b", 5, "f", "k"),
        (4, "one two three\nfour", "xx", "b", 5, "f", "k"),
        (4, "other text", "xx", "b", 5, "f", "k"),
        (5, " \n\t\n ", "de", "", 5, "f", "k"),
        (6, "Ünï  cödé\x1c \x85 \U0001f600 日本語\r\nİK", "de", "", 5, "f", "k"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)

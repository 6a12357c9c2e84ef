"""Small tables with the odd rows that every operator has to take."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_texts() -> list[tuple]:
    words = [f"word{k % 37} of{k % 11} the{k % 5}" for k in range(400)]
    long = " ".join(words * 20)
    return [
        (1, "Hello World, this is A text.", "en", "a", 28),
        (2, "hello world, THIS is a text.", "en", "b", 28),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (None, "no id here " * 30, "de", "b", 1),
        (None, "no id here " * 30, "de", "b", 1),
        (6, long, "en", "a", 1),
        (7, long + " tail", "en", "a", 1),
        (8, " \t\n\x0b\x0c\r ", "en", "c", 1),
        (9, "ÄÖ é́ 日本語 ▁ <|endoftext|> </s> \x00\x1c x \U0001f600", "xx", "c", 1),
        (10, "a" * 3000, "en", "d", 1),
        (11, "same row", "en", "a", 1),
        (11, "same row", "en", "a", 1),
        (12, "line\nline\nother line\n\n" * 40, "en", None, 1),
    ]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(odd_texts(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with columns named like those that operators add."""
    from pyspark.sql import functions as F

    names = (
        "size kept keep_id copies target source_size digest bearer row print root counts w lines place before spread size_class "
        "n_words label toxic quality score tokens file packed spans salt"
    ).split()
    return docs.withColumns({n: F.lit(-1) for n in names})


@pytest.fixture(scope="session")
def sample_dir():
    return os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

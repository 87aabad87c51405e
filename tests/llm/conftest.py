"""Small tables with every kind of odd row; the session fixture is the library's."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"

#: Extra columns whose names operators use inside.
CLASHES = "id string, fp string, key string, bucket string, score string, size string, rank string, words string, spans string, flush string, part string, h string, at string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"word{i % 977} and the" for i in range(9000))
    texts = [
        (1, "The quick brown fox jumps over the lazy dog and the cat.", "en", "s"),
        (2, None, "en", "s"),
        (3, "", None, None),
        (4, " \n\t ", "fr", "s"),
        (5, "Der schnelle braune Fuchs springt über den faulen Hund.", "de", "t"),
        (5, "Der schnelle braune Fuchs springt über den faulen Hund.", "de", "t"),
        (6, long, "en", None),
        (7, "123 456 --- !!!", None, "s"),
        (None, "The quick brown fox jumps over the lazy dog and the cat.", "en", "s"),
        (9, "été   🙂 <|endoftext|> don't  x", "fr", "t"),
        (10, "the QUICK brown fox jumps over the lazy dog and the cat.", "en", "s"),
    ]
    names = [c.split()[0] for c in CLASHES.split(", ")]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + CLASHES
    return spark.createDataFrame([(*t, len(t[1]) if t[1] else None, *(["x"] * len(names))) for t in texts], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def document_rows(documents):
    return sorted(documents.collect(), key=lambda r: r["doc_id"])


@pytest.fixture(scope="session")
def tokenizer_file():
    from medallion.llm.queries import tokenizer_path

    return tokenizer_path()

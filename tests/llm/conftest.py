import os

import public_tokenizers
import pytest

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names may clash."""
    long = " ".join(f"word{i % 700} the" for i in range(20_000))
    data = [
        (1, None, "en", "a", 5, "x"),
        (2, "", "en", None, 0, "x"),
        (3, " \n\t ", None, "a", 4, None),
        (4, long, "en", "a", len(long), "x"),
        (5, "one two", "de", "b", 7, "x"),
        (5, "one two", "de", "b", 7, "x"),
        (None, "a row without an id", "en", "b", None, "x"),
        (7, "Straße 　 naïve 12 ünï\x00 \U0001f600", "fr", "b", 20, "x"),
    ]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, sequence_id string"
    )

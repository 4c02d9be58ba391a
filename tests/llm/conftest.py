import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from tollcast.llm.common import importable
    from tollcast.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    yield importable(s)
    s.stop()


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """NULLs in every column, empty and white texts, ties, repeated rows, a long text."""
    long = "lorem ipsum dolor " * 30_000
    rows = [(1, "", "en", "a", 0), (2, None, "en", "a", None), (3, " \t\n ", None, None, 4),
            (4, "same words in this text here", "en", "b", 28),
            (4, "same words in this text here", "en", "b", 28),
            (5, "same words in this text here", "fr", "b", 28),
            (None, "no id on this row of text", "en", None, 25), (6, long, "la", "c", len(long)),
            (7, "one", "en", "a", 3), (8, "12345 !!", None, "a", 8)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)

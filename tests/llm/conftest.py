import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("needs the given tables")
    return SF


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in all columns, empty and very long texts, repeated rows, equal texts, columns that clash with names operators use."""
    long = "word " * 30_000 + "ende"
    some = "Das ist ein kleiner Text mit genug Wörtern für ein Fenster von dreizehn Wörtern und noch mehr"
    rows = [
        (1, None, None, 1, None),
        (2, "", "en", 2, "a"),
        (3, long, "en", 3, "b"),
        (4, some, "de", 4, "c"),
        (5, some, "de", 5, "c"),
        (5, some, "de", 5, "c"),
        (6, "!!! 123 ???", None, None, None),
        (None, some, "de", 7, "d"),
        (None, None, None, None, None),
        (8, "a\tb\n c  d", "fr", 8, "e"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id int, row string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)

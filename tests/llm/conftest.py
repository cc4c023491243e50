import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and columns whose names the operators use themselves."""
    long_text = " ".join(f"word{k % 977} again" for k in range(30_000))
    plain = "One plain sentence of ordinary words follows another, and none of them comes twice in this short text of clean prose for tests."
    data = [(None, None, None, None, None, 1, "x"), (1, "", "en", "a", 0, 2, None), (1, "", "en", "a", 0, 2, None), (2, " \n\t ", "en", None, 4, 3, "y"), (3, plain, "en", "a", len(plain), 4, "z"), (4, plain, "en", "a", len(plain), 4, "z"), (4, plain, "en", "a", len(plain), 4, "z"), (5, long_text, "de", "b", len(long_text), 5, "é"), (None, plain + " \U0001f600 éè", None, "c", 3, 6, "w")]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, rank int, anchor string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)

"""Small tables that hold every case the operators define a result for."""

from __future__ import annotations

import pytest
from llm_text import prose

SMALL_SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("k", "n", "size", "score", "shard", "slot", "row", "part", "own", "place", "found", "email",
           "lang_pred", "n_lines", "tokens", "label", "law", "held_out", "root", "pattern", "copies")


@pytest.fixture(scope="session")
def edge_rows():
    long = prose(1, 40_000)
    a = prose(2, 120)
    words = a.split()
    near = " ".join([*words[:-2], "changed", "ending"])
    rows = [
        (1, a, "en", "s1"), (2, None, "en", "s1"), (3, "", None, "s2"), (None, prose(3, 30), "de", "s1"),
        (4, long, "en", None), (1, a, "en", "s1"), (5, " \t\n ", "de", "s2"), (6, "!!! 123", None, None),
        (7, a, "en", "s3"), (8, near, "en", "s3"), (9, "two words", "de", "s2"), (10, "Two  WORDS", "de", "s2"),
        (None, None, None, None), (11, "é \U0001F600 ß\u0001\u0002 x@y.zz +12 345 678 901", "fr", "s1"),
        (12, "x" * 200_000, "en", "s1"), (None, "", "en", "s2"),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows, SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL_SF}/documents.parquet")

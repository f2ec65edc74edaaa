import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
#: Texts that every operator must bear: none, empty, blank, no letter, very long, repeated.
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "12345 !!"), (5, "one two"), (6, "word " * 30_000),
       (7, "x" * 50_000), (8, "one two"), (8, "one two"), (None, "one two"), (None, None)]


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM read_parquet('{SF}/documents.parquet')").fetchall()


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns named like what the operators add."""
    from tickwise.llm.common import bound_batches
    bound_batches(spark)
    names = ["fp", "hits", "bpe", "score", "cut", "shard", "slot", "host", "path", "next", "sketch", "toxicity"]
    rows = [(i, t, "en", "s", *["clash"] * len(names)) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                 + ", ".join(f"{n} string" for n in names))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)

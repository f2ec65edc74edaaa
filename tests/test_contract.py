"""Driver contract: entry() and every queries() entry against its DuckDB
oracle on the small landed tables (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import canon, digest  # noqa: E402
from tickwise.plans import catalog  # noqa: E402
from tickwise.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
NO_ORACLE = {"gbt_scores", "gbt_search", "oof_cutoffs", "pooled_report"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"symbol", "date", "target_3m", "rsi", "vix", "rs_america"} <= set(df.columns)


def test_every_query_has_oracle_except_training():
    q, o = E.queries(), E.oracle_sql()
    assert set(catalog.QUERIES) - set(o) == NO_ORACLE
    assert set(o) <= set(q)


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(catalog.QUERIES)))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF).toPandas()
    ddf = con.sql(E.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert len(sdf) == len(ddf)
    assert digest(canon(sdf)) == digest(canon(ddf))

"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive values)."""

import os
import sys

import duckdb
import pytest
from helpers import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


# the training-data operators have tests of their own
OWN = sorted(set(E.queries()) - set(E.LLM_QUERIES))


def test_every_query_has_an_oracle():
    assert set(OWN) == set(E.oracle_sql()) - set(E.LLM_SQL)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    spark_rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, spark_rows) == rows_of(cols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "rank_within_direction"

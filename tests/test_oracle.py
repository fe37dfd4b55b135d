"""Every registered query against its DuckDB oracle (the driver's gate, locally)."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import compare
from tessel.sources.tables import TABLES

from .conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert df.columns  # rows-only queries: stable schema, runs
        return
    res = duck.execute(ORACLES[name])
    problems = compare(df.columns, rows, [d[0] for d in res.description], res.fetchall())
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "symbol", "quantity", "returned", "sales"]
    assert df.count() > 0

"""Queries over documents read all line items: none is left out for its quantity, discount or return flag."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import compare
from tessel.sources.tables import SCHEMAS

# Supplier 1: small sales, nothing returned; 2: small returns in two quarters of one year; 3: nothing at all.
SUPPLIERS = [(1, "S1", 5, 500.0), (2, "S2", 6, 1500.0), (3, "S3", 7, 9000.0)]
ITEMS = [(1, 3.0, 0.0, "N", dt.datetime(2024, 1, 5)), (1, 4.0, 0.02, "N", dt.datetime(2023, 8, 5)),
         (2, 5.0, 0.09, "R", dt.datetime(2024, 2, 5)), (2, 6.0, 0.09, "R", dt.datetime(2024, 5, 5))]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(SUPPLIERS, SCHEMAS["supplier"]).write.parquet(f"{sf}/supplier.parquet")
    items = [(i, 1, s, 1, q, 10.0 * q, d, 0.0, flag, "F", day) for i, (s, q, d, flag, day) in enumerate(ITEMS)]
    spark.createDataFrame(items, SCHEMAS["lineitem"]).write.parquet(f"{sf}/lineitem.parquet")
    con = duckdb.connect()
    for t in ("supplier", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    yield sf, con
    con.close()


def rows(spark, made, name):
    """The query's rows, equal to those of its SQL."""
    sf, con = made
    df = E.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    assert not compare(df.columns, got, [d[0] for d in res.description], res.fetchall())
    return sorted(got)


def test_metric_width_counts_all_series(spark, made):
    assert rows(spark, made, "metric_width") == [("S1", 3, 4), ("S2", 3, 6), ("S3", 3, 0)]


def test_series_bearing_counts_all_periods(spark, made):
    assert rows(spark, made, "series_bearing") == [("S1", 2, 2), ("S2", 1, 2)]


def test_split_keeps_all_annual_rows(spark, made):
    day = dt.date
    assert rows(spark, made, "split_typed_gappy_annual") == [
        (day(2023, 1, 1), "S1", 4.0, None, 40.0), (day(2024, 1, 1), "S1", 3.0, None, 30.0), (day(2024, 1, 1), "S2", 11.0, 11.0, 110.0)]

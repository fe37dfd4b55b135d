"""Entity directory and keyed document selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def directory(records: DataFrame, symbol_col: str, predicate: Column | None = None) -> DataFrame:
    """Symbols of the directory records matching ``predicate``.

    On parquet the predicate is pushed into the scan and only the referenced
    columns are read.
    """
    df = records if predicate is None else records.filter(predicate)
    return df.select(F.col(symbol_col).alias("symbol"))


def sorted_symbols(symbols: DataFrame) -> DataFrame:
    """Ascending symbol order (L1): a range-partitioned global sort."""
    return symbols.orderBy("symbol")


def first_symbols(symbols: DataFrame, n: int) -> DataFrame:
    """The first ``n`` symbols in order (L2): a top-k, each partition keeps only
    its own first ``n`` before the final merge, so nothing else is shuffled."""
    return symbols.orderBy("symbol").limit(n)


def for_symbols(docs: DataFrame, symbols: DataFrame) -> DataFrame:
    """Documents of the listed symbols only (S2, re-aimed as a left-semi join).

    The directory side carries one column; AQE turns the join into a
    broadcast when the directory's runtime size is under the threshold.
    """
    return docs.join(symbols.select("symbol").distinct(), "symbol", "left_semi")

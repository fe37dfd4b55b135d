"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

if TYPE_CHECKING:
    import pyarrow as pa

#: The white space that separates words (space and \x09 to \x0D).
SPACE = " \t\n\x0b\f\r"
SPACE_RE = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text: maximal runs of anything but SPACE."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where a lambda in ``body`` refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared scratch folder and read them back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Marked for broadcast if it has at most ``rows`` rows; else left to a shuffled join. For settled tables of narrow rows."""
    return F.broadcast(df) if df.count() <= rows else df


def slices(batch: pa.RecordBatch, column: int, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``rows`` rows and, but for a longer text alone, ``size`` bytes of the text column."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        until = min(max(full, at + 1), at + rows)
        yield batch.slice(at, until - at)
        at = until

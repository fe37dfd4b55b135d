"""Positional (zip) join and new-key detection.

``with_row_index`` numbers rows 1..N in a total order without funnelling the
data through one task (a window with no partition would): the frame is range
partitioned and sorted within partitions, each row gets its position inside
its partition, and the per-partition counts (one row per partition, so their
size is bounded by the partition count) give each partition's offset.

The range-partitioned frame is materialised once with a reliable
``checkpoint()`` (in the session's shared checkpoint folder) before both
consumers read it. Otherwise the counts and the rows would come from two
separately planned range exchanges, whose sampled boundaries need not agree,
and a recomputation after an executor loss could move rows between
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

_LOW_BITS = (1 << 33) - 1


def with_row_index(df: DataFrame, order_cols: Sequence[str], name: str = "rn",
                   num_partitions: int | None = None) -> DataFrame:
    """Append a 1-based row number following ``order_cols``.

    ``order_cols`` must be a total order (unique) for the numbering to be
    deterministic across task retries.
    """
    cols = list(order_cols)
    checkpoint_root(df.sparkSession)  # shared folder (set locally only if unset)
    ranged = (df.repartitionByRange(num_partitions, *cols) if num_partitions
              else df.repartitionByRange(*cols)).sortWithinPartitions(*cols).checkpoint(eager=True)
    # monotonically_increasing_id = partition id in the upper bits, position
    # within the partition in the lower 33 bits.
    mid = F.monotonically_increasing_id()
    local = ranged.select("*", F.shiftright(mid, 33).alias("_pid"), mid.bitwiseAND(_LOW_BITS).alias("_pos"))
    sizes = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    )
    out = local.join(F.broadcast(offsets), "_pid")  # one row per partition
    return out.select(*df.columns, (F.coalesce("_off", F.lit(0)) + F.col("_pos") + 1).cast("bigint").alias(name))


def zip_join(left: DataFrame, left_order: Sequence[str], right: DataFrame,
             right_order: Sequence[str], name: str = "rn", pad: bool = False) -> DataFrame:
    """Pair the i-th row of ``left`` with the i-th row of ``right``.

    Both sides must have equally many rows, else a ValueError says so before
    anything is sorted; with ``pad`` the rows beyond the shorter side are
    paired with nulls. No row is lost.
    """
    if not pad and (n := left.count()) != (m := right.count()):
        raise ValueError(f"zip_join: {n} rows on the left, {m} on the right")
    return with_row_index(left, left_order, name).join(with_row_index(right, right_order, name), name,
                                                       "full_outer" if pad else "inner")


def new_keys(current: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``current`` absent from ``seen`` (J4, batch form).

    An anti join written as one grouped aggregation: the keys of both sides
    are tagged with their side, unioned, and grouped by key; a key is new if
    no ``seen`` row reached its group. There is one exchange, and partial
    aggregation runs before it on both sides, so a hot key leaves each map
    task as a single row (an anti join of the de-duplicated sides would not
    keep that: Catalyst pushes the anti join below the ``distinct``, and a
    sort-merge join would then move every row of a hot key to one task).
    A null key is a key like any other: new once.
    """
    k = list(keys)
    tagged = current.select(*k, F.lit(False).alias("_seen")).unionByName(
        seen.select(*k, F.lit(True).alias("_seen")))
    return tagged.groupBy(*k).agg(F.max("_seen").alias("_seen")).filter(~F.col("_seen")).select(*k)

"""Data-quality reports and bad-record isolation (Q1, Q2, A3).

The reference logs exceptions and drops the whole entity; here malformed
records are flagged with a reason and kept, so callers can route them to a
quarantine table. Quality figures come from one aggregation job.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import with_quarantine


def split_quarantine(df: DataFrame, text_col: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: good rows with the parsed fields, bad rows with their raw text and reason."""
    flagged = with_quarantine(df, text_col, schema)
    good = flagged.filter(F.col("reason").isNull()).select(
        *[c for c in df.columns if c != text_col], "parsed.*")
    bad = flagged.filter(F.col("reason").isNotNull()).select(*df.columns, "reason")
    return good, bad


def quarantine_counts(df: DataFrame, text_col: str, schema: T.StructType) -> DataFrame:
    """``ok, n``: how many records parse (Q1)."""
    flagged = with_quarantine(df, text_col, schema)
    return flagged.groupBy(F.col("reason").isNull().alias("ok")).agg(F.count(F.lit(1)).alias("n"))


def quality_report(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                   cast_to: str = "float") -> DataFrame:
    """Per value column: ``column_name, n, n_null, n_bad_cast, n_dup_keys`` (Q2).

    * ``n_null``: null values;
    * ``n_bad_cast``: non-null values that do not cast to ``cast_to``;
    * ``n_dup_keys``: rows beyond the first per key (same for every column);
      keys compare null-safely, so a null in a key is a value of its own, not
      a duplicate.

    One aggregation over the frame, then a generator to turn the single
    result row into one row per column.
    """
    aggs = [F.count(F.lit(1)).alias("n"),
            (F.count(F.lit(1)) - F.count_distinct(F.struct(*[F.col(k) for k in keys]))).alias("dup")]
    for i, c in enumerate(values):
        col = F.col(c)
        aggs.append(F.count_if(col.isNull()).alias(f"null{i}"))
        aggs.append(F.count_if(col.isNotNull() & col.try_cast(cast_to).isNull()).alias(f"bad{i}"))
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n"),
                              F.col(f"null{i}").alias("n_null"), F.col(f"bad{i}").alias("n_bad_cast"),
                              F.col("dup").alias("n_dup_keys"))
                     for i, c in enumerate(values)])
    return one.select(F.inline(rows))


def observed_count(df: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """Attach a row-count observation (A3): the count is collected by the job
    that consumes the frame, no extra job."""
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")  # names must not repeat within a session
    return df.observe(obs, F.count(F.lit(1)).alias("num_records")), obs


# --- quality across dates (Q2): sketches that merge -----------------------------

# Log2 of the HLL sketch's registers (relative standard error about 1.04 / sqrt(2^12) = 1.6 %), the k of the KLL sketch
# (rank error below 1.65 % at 99 % confidence for k = 200), and the quantiles that are compared.
HLL_LOG_K, KLL_K = 12, 200
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (HLL_LOG_K / 2), 0.0165
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)


def sketch_by(df: DataFrame, by: str | None, values: Sequence[str]) -> DataFrame:
    """``[by,] column_name, n, n_null, distinct, ranks`` per numeric column: counts and two sketches of a few KB each.

    One aggregation with partial sketches before its exchange. Kept beside a
    snapshot, these rows stand for it in every later comparison: merged or
    compared, they never need its data again.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(values):
        x = F.col(c).cast("double")
        aggs += [F.count_if(x.isNull()).alias(f"null{i}"), F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_LOG_K)).alias(f"hll{i}"),
                 F.kll_sketch_agg_double(F.when(~F.isnan(x), x), F.lit(KLL_K)).alias(f"kll{i}")]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n"), F.col(f"null{i}").alias("n_null"), F.col(f"hll{i}").alias("distinct"),
                              F.col(f"kll{i}").alias("ranks")) for i, c in enumerate(values)])
    return df.groupBy(by).agg(*aggs).select(by, F.inline(rows)) if by else df.agg(*aggs).select(F.inline(rows))


def sketch(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """The sketches of one snapshot."""
    return sketch_by(df, None, values)


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """The sketches of several snapshots as one per column (and ``by``)."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("ranks").alias("ranks"))


def summary(sketches: DataFrame) -> DataFrame:
    """``n, null_share, n_distinct, q10 ... q90`` of each sketch row; quantiles are null without values."""
    some = F.kll_sketch_get_n_double("ranks") > 0
    quantiles = [F.when(some, F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(f"q{round(100 * q)}") for q in QUANTILES]
    keys = [c for c in sketches.columns if c not in ("n", "n_null", "distinct", "ranks")]
    return sketches.select(*keys, "n", F.try_divide("n_null", "n").alias("null_share"), F.hll_sketch_estimate("distinct").alias("n_distinct"), *quantiles)


def drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """How the columns of one snapshot's sketches differ from another's, per column of either.

    ``null_shift``: change of the share of nulls; ``distinct_ratio``: new over
    old distinct values (error DISTINCT_ERROR on each side at three standard
    errors); ``rank_shift``: the greatest difference of the two distributions'
    middle ranks at any of the new percentiles (error RANK_ERROR on each side,
    and a hundredth for the grid).
    """
    grid = F.array(*[F.lit(k / 100) for k in range(1, 100)])

    def side(df: DataFrame, name: str) -> DataFrame:
        some = F.kll_sketch_get_n_double("ranks") > 0
        at = F.when(some, F.kll_sketch_get_quantile_double("ranks", grid))
        return df.select("column_name", *[c.alias(f"{name}_{k}") for k, c in (
            ("n", F.col("n")), ("nulls", F.try_divide("n_null", "n")), ("distinct", F.hll_sketch_estimate("distinct")), ("at", at))])

    def middle(grid_: Column, x: Column) -> Column:
        return (F.size(F.filter(grid_, lambda y: y < x)) + F.size(F.filter(grid_, lambda y: y <= x))) / 200

    both = side(old, "old").join(side(new, "new"), "column_name", "full_outer")
    shift = F.array_max(F.transform("new_at", lambda x: F.abs(middle(F.col("old_at"), x) - middle(F.col("new_at"), x))))
    return both.select("column_name", "old_n", "new_n", (F.col("new_nulls") - F.col("old_nulls")).alias("null_shift"),
                       F.try_divide("new_distinct", "old_distinct").alias("distinct_ratio"), F.when(F.col("old_at").isNotNull(), shift).alias("rank_shift"))

"""Series reshaping: long form, alignment by array position or by period.

A parsed document carries every series of one entity, so alignment never
needs a shuffle: each document is expanded into its aligned rows with
higher-order functions and one generator (``inline``). The per-row work is
bounded by the series length of that document; skew across entities does not
matter because no rows of different documents meet.

* position mode (the reference behaviour): arrays are zipped by index, the
  row date is the first non-null period in column order, a shorter array is
  padded with nulls;
* period mode: one row per distinct period over the chosen series, each value
  the max of the points with that period (deterministic on duplicates);
  one sort of the document's points, then each period's run is sliced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnSpec = Mapping[str, tuple[str, str]]  # output name -> (freq, metric)


def sql_str(s: str) -> str:
    """A Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_ident(s: str) -> str:
    """A Spark SQL identifier (backticked, so dots and spaces are plain text)."""
    return "`" + s.replace("`", "``") + "`"


_POINTS_SQL = "array<struct<period:date,v:double>>"


def series_array_sql(freq: str, metric: str, series: str = "series") -> str:
    """``series[freq][metric]``; missing levels give an empty array, never null.

    ``arrays_zip`` returns null if any argument is null, which would lose the
    whole document, so every lookup is coalesced to a typed empty array.
    """
    return (f"coalesce({sql_ident(series)}[{sql_str(freq)}][{sql_str(metric)}], "
            f"CAST(array() AS {_POINTS_SQL}))")


def series_array(freq: str, metric: str, series: str = "series") -> Column:
    return F.expr(series_array_sql(freq, metric, series))


def columns_for(freq: str, metrics: Sequence[str], prefix: str = "") -> dict[str, tuple[str, str]]:
    return {f"{prefix}{m}": (freq, m) for m in metrics}


def period_prep_sql(spec: ColumnSpec, tag: str, series: str = "series") -> list[list[tuple[str, str]]]:
    """Projections to run *before* period-mode alignment: lists of ``(name, sql)``.

    1. ``{tag}_pts``: every point of the spec's series tagged with its series
       index, and an empty point for every period and index, sorted by
       ``(period, index, v)`` (nulls first);
    2. ``{tag}_runs``: the last point of each (period, index), so every period
       has exactly one entry per series, in index order, null-safe in period.

    Alignment reads entry ``k * n + i`` for series i of the k-th period: besides
    the sort, the work is the size of the dense result, whatever the number of
    series. These must be columns of prior projections: an expression
    referenced inside a lambda would be re-evaluated for every element.
    """
    arrays = [series_array_sql(f, m, series) for f, m in spec.values()]
    tagged = ", ".join(
        f"transform({a}, _p -> named_struct('period', _p.period, 'i', {i}, 'v', _p.v))"
        for i, a in enumerate(arrays))
    periods = ", ".join(f"transform({a}, _p -> _p.period)" for a in arrays)
    empty = (f"flatten(transform(array_distinct(flatten(array({periods}))), _d -> transform(sequence(0, {len(arrays) - 1}), "
             f"_i -> named_struct('period', _d, 'i', _i, 'v', CAST(NULL AS DOUBLE)))))")
    pts = sql_ident(f"{tag}_pts")
    return [
        [(f"{tag}_pts", f"sort_array(concat(flatten(array({tagged})), {empty}), true)")],
        [(f"{tag}_runs",
          f"filter({pts}, (_x, _j) -> _j + 1 = size({pts}) OR get({pts}, _j + 1).i <> _x.i "
          f"OR NOT (get({pts}, _j + 1).period <=> _x.period))")],
    ]


def with_period_prep(docs: DataFrame, specs: Mapping[str, ColumnSpec], align: str) -> DataFrame:
    """``docs`` plus the period-mode preparation columns of each tagged spec."""
    if align != "period":
        return docs
    steps: list[list] = [[], []]
    for tag, spec in specs.items():
        if spec:
            for k, cols in enumerate(period_prep_sql(spec, tag)):
                steps[k] += [F.expr(sql).alias(name) for name, sql in cols]
    out = docs
    for cols in steps:
        if cols:
            out = out.select("*", *cols)
    return out


def aligned_rows_sql(spec: ColumnSpec, align: str = "position", series: str = "series",
                     tag: str = "_al") -> str:
    """Per document: SQL for ``array<struct<date, <name>...>>`` of aligned rows.

    One Spark SQL expression (higher-order functions), so it crosses to the
    JVM in one call. Period mode reads the columns of
    :func:`with_period_prep` for the same ``tag``.
    """
    if align not in ("position", "period"):
        raise ValueError(f"align must be 'position' or 'period', not {align!r}")
    names = list(spec)
    if not names:  # no series columns requested: no series rows
        return "CAST(array() AS array<struct<date:date>>)"
    if align == "position":
        arrays = [series_array_sql(f, m, series) for f, m in spec.values()]
        fields = [f"_z.`{i}`" for i in range(len(names))]
        date = "coalesce(" + ", ".join(f"{x}.period" for x in fields) + ")"
        values = ", ".join(f"{sql_str(n)}, {x}.v" for n, x in zip(names, fields))
        return (f"transform(arrays_zip({', '.join(arrays)}), "
                f"_z -> named_struct('date', {date}, {values}))")
    runs, n = sql_ident(f"{tag}_runs"), len(names)
    values = ", ".join(f"{sql_str(x)}, {runs}[CAST(_k * {n} + {i} AS INT)].v" for i, x in enumerate(names))
    places = f"filter(sequence(0, size({runs}) DIV {n}), _k -> _k * {n} < size({runs}))"
    return (f"transform({places}, _k -> named_struct('date', {runs}[CAST(_k * {n} AS INT)].period, {values}))")


def aligned_rows(spec: ColumnSpec, align: str = "position", series: str = "series",
                 tag: str = "_al") -> Column:
    return F.expr(aligned_rows_sql(spec, align, series, tag))


def has_points_sql(freq: str, metrics: Sequence[str], series: str = "series") -> str:
    """SQL: does the document have any point for ``freq`` among ``metrics``?

    Equivalent to "aligns to at least one row" in both modes.
    """
    if not metrics:
        return "false"
    sizes = ", ".join(f"size({series_array_sql(freq, m, series)})" for m in metrics)
    return f"(greatest({sizes}, 0) > 0)"


def align(docs: DataFrame, spec: ColumnSpec, align: str = "position",
          keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """Aligned wide frame: ``*keep, date, <spec names>``."""
    prepared = with_period_prep(docs, {"_al": spec}, align)
    return prepared.select(*keep, F.inline(aligned_rows(spec, align, tag="_al")))


def align_freq(docs: DataFrame, freq: str, metrics: Sequence[str], align_mode: str = "position",
               prefix: str = "", keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """One frequency aligned; metric order decides the position-mode date."""
    return align(docs, columns_for(freq, metrics, prefix), align_mode, keep)


def full_outer_series(docs: DataFrame, freqs: Sequence[str], metrics: Sequence[str],
                      keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """All ``freq x metric`` series outer-joined on period, per document.

    Columns are ``{freq}_{metric}``; rows come out in ascending period order
    within each document, which is the per-entity sort of the reference
    without a global sort.
    """
    spec: dict[str, tuple[str, str]] = {}
    for f in freqs:
        spec.update(columns_for(f, metrics, f"{f}_"))
    return align(docs, spec, "period", keep)


def to_long(docs: DataFrame, keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """Canonical long form: ``*keep, freq, metric, pos, date, v`` (R2).

    ``pos`` is the 0-based index inside the source array.
    """
    by_freq = docs.select(*keep, F.explode(F.col("series")).alias("freq", "_m"))
    by_metric = by_freq.select(*keep, "freq", F.explode("_m").alias("metric", "_a"))
    return by_metric.select(*keep, "freq", "metric", F.posexplode("_a").alias("pos", "_p")) \
        .select(*keep, "freq", "metric", "pos", F.col("_p.period").alias("date"), F.col("_p.v").alias("v"))


def pivot_long(long_df: DataFrame, keys: Sequence[str], name_col: str, value_col: str,
               names: Sequence[str]) -> DataFrame:
    """Long -> wide for points that come from *different* rows (one shuffle).

    Used when the points of one entity are spread over many input rows (for
    instance several landings), where the row-local form does not apply.
    The name list is always passed so Spark runs no extra job to find it;
    partial aggregation runs before the shuffle, so a hot key is pre-reduced.
    """
    return long_df.groupBy(*keys).pivot(name_col, list(names)).agg(F.max(value_col))


def freq_full_outer(quarterly: DataFrame, annual: DataFrame,
                    keys: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Two independently produced frames side by side on their keys.

    This is the general two-input form (frames from different sources); the
    full outer join shuffles both sides on the keys, which are unique per side.
    """
    return quarterly.join(annual, list(keys), "full_outer")


def doc_freq_full_outer(docs: DataFrame, metrics: Sequence[str],
                        prefixes: Mapping[str, str] | None = None,
                        keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """J3 when both frequencies come from the same document: row-local.

    Equal to aligning each frequency by period and full-outer joining the
    two on ``(symbol, date)``, but without the join: the document already
    holds both sides, so the points of every ``freq x metric`` are aligned
    by period in one pass and nothing is shuffled.
    """
    prefixes = dict(prefixes or {"quarterly": "q_", "annual": "a_"})
    spec: dict[str, tuple[str, str]] = {}
    for f, p in prefixes.items():
        spec.update(columns_for(f, metrics, p))
    return align(docs, spec, "period", keep)

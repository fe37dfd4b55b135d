"""Metric-side reshaping, the typed (discriminated) union and its split.

The reference builds, per entity, three frames (metric row, quarterly rows,
annual rows), pads them to one column set, tags them with ``type`` and unions
them; a later step splits them again by ``type``. Here the typed frame of *all*
entities comes from one scan: each document is expanded with one generator
into its metric row plus its aligned series rows, all of one struct type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import (PASSTHROUGH, QUARANTINE, TYPE_ANNUAL, TYPE_METRIC, TYPE_QUARTERLY, by_freq, group_of, quoted, tagged,
                                unique_names)
from ..functions.types import cast_to, widened
from .series import aligned_rows_sql, columns_for, has_points_sql, sql_ident, sql_str, with_period_prep


def metric_wide(docs: DataFrame, keys: Sequence[str], keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """Flat metric object -> one column per key (P17 for a map); a key called
    like a column of ``keep`` gets ``metric_`` in front."""
    names = unique_names(keys, keep)
    return docs.select(*keep, *[tagged(F.col("metric")[k], n, TYPE_METRIC, k) for k, n in zip(keys, names)])


def metric_long(docs: DataFrame, keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """Flat metric object -> ``*keep, metric, value`` rows (P17, long form)."""
    return docs.select(*keep, F.explode("metric").alias("metric", "value"))


def attach_constant(df: DataFrame, **constants) -> DataFrame:
    """Attach true constants to every row (P10); keys already travel with rows."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in constants.items()])


def has_series(docs: DataFrame) -> DataFrame:
    """Documents whose series object is present and non-empty."""
    return docs.filter(F.col("series").isNotNull() & (F.size("series") > 0))


def non_empty_series(docs: DataFrame) -> Column:
    """Per document: the series map without empty arrays."""
    return F.transform_values(F.col("series"),
                              lambda _, m: F.map_filter(m, lambda _k, a: F.size(a) > 0))


def typed_union(docs: DataFrame, metric_keys: Sequence[str],
                series_metrics: Mapping[str, Sequence[str]] | Sequence[str],
                align_mode: str = "period", bearing_only: bool = False, corrupt: str | None = None,
                passthrough: Sequence[str] = ()) -> DataFrame:
    """One wide typed frame for all documents (F1: P11, P12, P13, U1).

    Columns: ``type, symbol, date, <metric keys>, quarterly_<m>..., annual_<m>...``,
    each tagged with its group and metric (column metadata), which is what the
    later steps go by; a name already taken gets ``metric_`` in front.
    ``series_metrics`` may differ by frequency. Missing column groups are typed
    nulls, so no type coercion happens. Each document becomes its metric row
    plus its aligned series rows through one ``inline`` of one SQL expression;
    no shuffle.

    ``bearing_only`` emits series rows only for documents that have both
    annual and quarterly points (W3 evaluated per document, which is how the
    reference decides it: per entity). ``corrupt`` names a column with the text
    of a malformed record: such a record becomes one row of type
    ``quarantine`` that holds the text, and nothing else. ``passthrough`` names
    columns of ``docs`` that every row of the document repeats (P10).
    """
    metrics = by_freq(series_metrics)
    wanted = [*metric_keys, *[f"quarterly_{m}" for m in metrics["quarterly"]], *[f"annual_{m}" for m in metrics["annual"]]]
    wanted_metrics = [*metric_keys, *metrics["quarterly"], *metrics["annual"]]
    keys = ["type", "symbol", "date", *([QUARANTINE] if corrupt else [])]
    names = unique_names([*wanted, *passthrough], keys)
    k, q, a = len(metric_keys), len(metric_keys) + len(metrics["quarterly"]), len(wanted)
    m_names, q_names, a_names, p_names = names[:k], names[k:q], names[q:a], names[a:]
    q_spec = {n: ("quarterly", m) for n, m in zip(q_names, metrics["quarterly"])}
    a_spec = {n: ("annual", m) for n, m in zip(a_names, metrics["annual"])}
    s_null, d_null = "CAST(NULL AS STRING)", "CAST(NULL AS DOUBLE)"

    def row(type_name: str, date: str, metric_vals: list[str], q_vals: list[str], a_vals: list[str], text: str = s_null) -> str:
        parts = [f"'type', {sql_str(type_name)}", "'symbol', symbol", f"'date', CAST({date} AS DATE)"]
        parts += [f"{sql_str(QUARANTINE)}, {text}"] if corrupt else []
        parts += [f"{sql_str(n)}, {v}" for n, v in zip(m_names, metric_vals)]
        parts += [f"{sql_str(n)}, {v}" for n, v in zip(q_spec, q_vals)]
        parts += [f"{sql_str(n)}, {v}" for n, v in zip(a_spec, a_vals)]
        parts += [f"{sql_str(n)}, {sql_ident(c)}" for n, c in zip(p_names, passthrough)]
        return "named_struct(" + ", ".join(parts) + ")"

    m_null, q_null, a_null = [s_null] * k, [d_null] * len(q_spec), [d_null] * len(a_spec)
    metric_row = "array(" + row(TYPE_METRIC, "NULL", [f"metric[{sql_str(x)}]" for x in metric_keys], q_null, a_null) + ")"
    q_rows = (f"transform({aligned_rows_sql(q_spec, align_mode, tag='_tq')}, _r -> "
              + row(TYPE_QUARTERLY, "_r.date", m_null, [f"_r.{sql_ident(n)}" for n in q_spec], a_null) + ")")
    a_rows = (f"transform({aligned_rows_sql(a_spec, align_mode, tag='_ta')}, _r -> "
              + row(TYPE_ANNUAL, "_r.date", m_null, q_null, [f"_r.{sql_ident(n)}" for n in a_spec]) + ")")
    series_rows = f"concat({q_rows}, {a_rows})"
    if bearing_only:
        keep = f"{has_points_sql('quarterly', metrics['quarterly'])} AND {has_points_sql('annual', metrics['annual'])}"
        series_rows = f"IF({keep}, {series_rows}, array())"
    rows = f"concat({metric_row}, {series_rows})"
    if corrupt:
        text = sql_ident(corrupt)
        rows = f"IF({text} IS NULL, {rows}, array({row(QUARANTINE, 'NULL', m_null, q_null, a_null, text)}))"
    typed = with_period_prep(docs, {"_tq": q_spec, "_ta": a_spec}, align_mode).select(F.expr(f"inline({rows})"))
    groups = [TYPE_METRIC] * k + [TYPE_QUARTERLY] * len(q_spec) + [TYPE_ANNUAL] * len(a_spec) + [PASSTHROUGH] * len(p_names)
    originals = [*wanted_metrics, *passthrough]
    out = [tagged(F.col(QUARANTINE), QUARANTINE, QUARANTINE, QUARANTINE)] if corrupt else []
    out += [tagged(F.col(quoted(n)), n, g, m) for n, g, m in zip(names, groups, originals)]
    return typed.select("type", "symbol", "date", *out)


def series_bearing(typed: DataFrame) -> DataFrame:
    """Per symbol: annual and quarterly row counts; keep symbols with both > 0.

    A grouped aggregation with map-side partial counts, so a hot symbol is
    reduced before the shuffle.
    """
    counts = typed.groupBy("symbol").agg(
        F.count_if(F.col("type") == TYPE_ANNUAL).alias("n_annual"),
        F.count_if(F.col("type") == TYPE_QUARTERLY).alias("n_quarterly"),
    )
    return counts.filter((F.col("n_annual") > 0) & (F.col("n_quarterly") > 0))


def split_by_type(typed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Typed frame -> ``metric``, ``quarterly_metric``, ``annual_metric`` by the
    ``type`` marker only (W1, P14, P15); a column's group is in its metadata
    (an untagged column counts as a metric, a passed-through one is in all three)."""
    fields = [f for f in typed.schema.fields if f.name not in ("type", "symbol", "date")]
    of = lambda *groups: [quoted(f.name) for f in fields if group_of(f) in groups]
    metric = typed.filter(F.col("type") == TYPE_METRIC).select("symbol", *of(TYPE_METRIC, PASSTHROUGH, None))
    quarterly = typed.filter(F.col("type") == TYPE_QUARTERLY).select("date", "symbol", *of(TYPE_QUARTERLY, PASSTHROUGH))
    annual = typed.filter(F.col("type") == TYPE_ANNUAL).select("date", "symbol", *of(TYPE_ANNUAL, PASSTHROUGH))
    return metric, quarterly, annual


def quarantined(typed: DataFrame) -> DataFrame:
    """``text, reason`` of the malformed records in a typed frame (Q1)."""
    return typed.filter(F.col("type") == QUARANTINE).select(
        F.col(QUARANTINE).alias("text"), F.lit("malformed json").alias("reason"))


def split_typed(typed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Typed frame -> ``metric``, ``quarterly_metric``, ``annual_metric`` (F2).

    This is the general form for a typed frame whose rows of one symbol may
    come from anywhere (e.g. read back from storage). Column groups come from
    the columns' metadata, so every column is kept (the reference's off-by-two
    slice is not reproduced). Series rows are kept only for series-bearing symbols (W3);
    the bearing set is one row per symbol, computed with partial counts, and
    joined with a left-semi join (AQE broadcasts it when its runtime size is
    under the broadcast threshold, and splits skewed partitions otherwise).
    When the typed frame is built from documents, ``typed_union(...,
    bearing_only=True)`` decides W3 per document instead and no join is needed.
    """
    bearing = series_bearing(typed).select("symbol")
    metric, _, _ = split_by_type(typed)
    series_rows = typed.filter(F.col("type") != TYPE_METRIC).join(bearing, "symbol", "left_semi")
    _, quarterly, annual = split_by_type(series_rows)
    return metric, quarterly, annual


def union_ragged(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union of frames whose column sets differ (U2); missing columns are
    null, columns of differing types take the type that holds all.

    The frames meet in pairs, and these in pairs again, so that a column passes
    as many projections as the tree has levels, not as there are frames. For
    many landed snapshots ``landing.read_ragged`` reads all of them in one pass
    instead, whatever their number.
    """
    fields = [df.schema.fields for df in frames]
    types = widened((f.name, f.dataType) for own in fields for f in own)
    parts = []
    for df, own in zip(frames, fields, strict=True):
        changed = {f.name: cast_to(F.col(quoted(f.name)), f.dataType, types[f.name]).alias(f.name, metadata=f.metadata) for f in own if f.dataType != types[f.name]}
        parts.append(df.select(*[changed.get(f.name, quoted(f.name)) for f in own]) if changed else df)
    while len(parts) > 1:
        parts = [reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def type_counts(typed: DataFrame) -> DataFrame:
    """Row count per frame type in one job (A1)."""
    return typed.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def metric_catalog(docs: DataFrame) -> DataFrame:
    """Which series metrics exist: ``freq, metric, n_symbols, n_points``.

    Empty arrays contribute nothing (exploding them yields no row).
    """
    pairs = docs.select("symbol", F.explode("series").alias("freq", "_m")) \
        .select("symbol", "freq", F.explode("_m").alias("metric", "_a")) \
        .filter(F.size("_a") > 0)
    return pairs.groupBy("freq", "metric").agg(
        F.count_distinct("symbol").alias("n_symbols"),
        F.sum(F.size("_a")).cast("bigint").alias("n_points"),
    )


def metric_width(docs: DataFrame) -> DataFrame:
    """Per document: number of metric keys and of non-empty series (A4). Row-local."""
    n_series = F.aggregate(F.map_values(F.coalesce(non_empty_series(docs),
                                                   F.create_map().cast(docs.schema["series"].dataType))),
                           F.lit(0), lambda acc, m: acc + F.size(m))
    return docs.select("symbol", _size0("metric").alias("n_metrics"), n_series.alias("n_series"))


def _size0(c: str) -> Column:
    """Size with 0 for null, whatever ``sizeOfNull``/ANSI say."""
    return F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(c))

"""Composite plans: documents -> staging tables -> facts.

The reference runs one small Spark job per entity and then merges the
per-entity frames with a left-deep union. Here every step is one lazy plan
over all documents at once: parse -> typed rows (one generator) -> split ->
one projection per fact. Past the parse, no step shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schema import FREQS, TYPE_ANNUAL, TYPE_METRIC, TYPE_QUARTERLY, by_freq, quoted, tagged, unique_names
from ..operators import facts, series


class Staging:
    """The three staging tables. Each is a lazy plan built on first access,
    so asking for one table never builds (or runs) the other two."""

    def __init__(self, metric, quarterly_metric, annual_metric):
        self._make = {"metric": metric, "quarterly_metric": quarterly_metric,
                      "annual_metric": annual_metric}
        self._built: dict[str, DataFrame] = {}

    def _get(self, name: str) -> DataFrame:
        if name not in self._built:
            make = self._make[name]
            self._built[name] = make() if callable(make) else make
        return self._built[name]

    metric = property(lambda self: self._get("metric"))
    quarterly_metric = property(lambda self: self._get("quarterly_metric"))
    annual_metric = property(lambda self: self._get("annual_metric"))

    def tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.metric, self.quarterly_metric, self.annual_metric


class Facts(Staging):
    """The three fact tables, lazily built like :class:`Staging`."""


def discover_metrics(docs: DataFrame) -> tuple[list[str], dict[str, list[str]]]:
    """Metric keys, and series metric names of each frequency, from the data.

    One scan: the names of both kinds are tagged with their side and exploded
    together, then reduced before the shuffle. The driver gets the distinct
    names, which the static schema needs. Callers that know the names pass
    them instead and no extra job runs.
    """
    names = F.expr(
        "concat(transform(coalesce(map_keys(metric), array()), _k -> named_struct('side', 'metric', 'k', _k)), "
        "flatten(transform(coalesce(map_entries(series), array()), _e -> transform(coalesce(map_keys(_e.value), array()), "
        "_k -> named_struct('side', _e.key, 'k', _k)))))")
    rows = docs.select(F.inline(names)).distinct().collect()
    found: dict[str, list[str]] = {}
    for r in sorted(rows):
        found.setdefault(r["side"], []).append(r["k"])
    return found.get("metric", []), {f: found.get(f, []) for f in FREQS}


def stage(docs: DataFrame, metric_keys: Sequence[str],
          series_metrics: Mapping[str, Sequence[str]] | Sequence[str], align_mode: str = "period") -> Staging:
    """F1 + F2: documents -> the three staging tables.

    Equal to ``split_by_type(typed_union(docs, ..., bearing_only=True))``
    (tested), but each table is projected straight from the documents, so
    materialising one table does not generate the rows of the other two.
    Series-bearing (W3) is decided per document; nothing shuffles.
    """
    metrics = by_freq(series_metrics)
    bearing = " AND ".join(series.has_points_sql(f, metrics[f]) for f in ("quarterly", "annual"))
    wanted = [*metric_keys, *[f"quarterly_{m}" for m in metrics["quarterly"]], *[f"annual_{m}" for m in metrics["annual"]]]
    names = unique_names(wanted, ("type", "symbol", "date"))
    k, q = len(metric_keys), len(metric_keys) + len(metrics["quarterly"])

    def metric_table() -> DataFrame:
        return docs.select("symbol", *[tagged(F.col("metric")[m], n, TYPE_METRIC, m) for n, m in zip(names[:k], metric_keys)])

    def series_table(freq: str, group: str, of: list[str]) -> DataFrame:
        spec = {n: (freq, m) for n, m in zip(of, metrics[freq])}
        out = series.align(docs.filter(F.expr(bearing)), spec, align_mode)
        return out.select("date", "symbol", *[tagged(F.col(quoted(n)), n, group, m) for n, (_, m) in spec.items()])

    return Staging(metric_table, lambda: series_table("quarterly", TYPE_QUARTERLY, names[k:q]),
                   lambda: series_table("annual", TYPE_ANNUAL, names[q:]))


def to_facts(staging: Staging, keep_source: bool = False) -> Facts:
    """staging -> typed facts."""
    return Facts(
        lambda: facts.metric_fact(staging.metric),
        lambda: facts.series_fact(staging.quarterly_metric, keep_source),
        lambda: facts.series_fact(staging.annual_metric, keep_source),
    )


def legacy_wide(docs: DataFrame, metric_keys: Sequence[str], series_metrics: Sequence[str], passthrough: Sequence[str] = ()) -> DataFrame:
    """per entity, all series outer-joined on period with the metric values,
    and the ``passthrough`` columns of ``docs``, repeated on every row. Metric and series come from the same document, so
    the "join on symbol" of the legacy code is a projection here.
    """
    spec: dict[str, tuple[str, str]] = {}
    for f in ("annual", "quarterly"):
        spec.update(series.columns_for(f, series_metrics, f"{f}_"))
    prepared = series.with_period_prep(docs, {"_lw": spec}, "period")
    return prepared.select("symbol", *[F.col("metric")[k].alias(k) for k in metric_keys], *[F.col(quoted(c)) for c in passthrough],
                           F.inline(series.aligned_rows(spec, "period", tag="_lw")))

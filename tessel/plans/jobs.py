"""Batch jobs over dated storage, one call per job (the reference's job list).

* :func:`transform_landing`: landed documents of one date -> the staging
  tables in one pass (S3 scan with partition pruning, optional metric
  discovery (P4), F1/F2, one K2 write partitioned by ``type``);
* :func:`update_lake`: staging of one date -> fact tables appended to (or
  replacing the date in) the lake (S7, F4, K3), for a selection of outputs (K9);
* :func:`update_warehouse`: staging of one date -> catalog tables (K4).

Each job is a few lazy plans and distributed writes; nothing is collected
except the distinct metric names when they are discovered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import CORRUPT
from ..functions.schema import DOC_SCHEMA, QUARANTINE, TYPE_ANNUAL, TYPE_METRIC, TYPE_QUARTERLY
from ..operators import nested, reshape
from ..sinks import writers
from ..sources import landing
from . import staging

STAGING_TABLES = ("metric", "quarterly_metric", "annual_metric")


def transform_landing(spark: SparkSession, landing_root: str, staging_root: str, snapshot_date: str,
                      metric_keys: Sequence[str] | None = None,
                      series_metrics: Mapping[str, Sequence[str]] | Sequence[str] | None = None,
                      align_mode: str = "period", fmt: str = "parquet",
                      passthrough: Mapping[str, T.DataType] | bool = False) -> dict:
    """Landed documents of ``snapshot_date`` -> staging, in one pass.

    The typed union (W3 decided per document) is written once, partitioned
    by ``type``, so the landing is parsed once however many staging tables
    there are. Malformed records go, as text, to the ``quarantine`` type of
    the same write and to no other table; a single value that does not fit its
    type is a null and costs nothing else. ``passthrough``: the documents' other
    top-level scalars, by name and type, that every row repeats (P10); True
    finds them, in one more scan. Returns the staging ``path``, per-type
    ``rows`` and the number of ``bad_values``, counted by observations on the
    write job itself (A3), not by extra jobs.
    """
    if passthrough is True:
        others = landing.scan_date_variant(spark, landing_root, snapshot_date).select(nested.rest(F.col("doc")).alias(nested.REST))
        passthrough = nested.scalar_fields(others)
    others = dict(passthrough or {})
    schema = T.StructType([*DOC_SCHEMA.fields, *[T.StructField(n, t) for n, t in others.items()]])
    docs = landing.scan_date_flagged(spark, landing_root, schema, snapshot_date)
    if metric_keys is None or series_metrics is None:
        found_keys, found_series = staging.discover_metrics(docs.filter(F.col(CORRUPT).isNull()))
        metric_keys = found_keys if metric_keys is None else metric_keys
        series_metrics = found_series if series_metrics is None else series_metrics
    misfits = Observation(f"values_{uuid.uuid4().hex[:8]}")
    docs = docs.observe(misfits, F.sum(landing.BAD_VALUES).alias("n"))
    typed = reshape.typed_union(docs, metric_keys, series_metrics, align_mode, bearing_only=True, corrupt=CORRUPT, passthrough=list(others))
    obs = Observation(f"staging_{uuid.uuid4().hex[:8]}")
    counted = typed.observe(obs, *[F.count_if(F.col("type") == t).alias(n) for n, t in
                                   zip((*STAGING_TABLES, QUARANTINE), (TYPE_METRIC, TYPE_QUARTERLY, TYPE_ANNUAL, QUARANTINE))])
    path = writers.stage_write_typed(counted, staging_root, snapshot_date, fmt)
    return {"path": path, "rows": dict(obs.get), "bad_values": misfits.get["n"] or 0}


def _read_staging(spark: SparkSession, staging_root: str, snapshot_date: str, fmt: str) -> staging.Staging:
    typed = landing.stage_read_typed(spark, staging_root, snapshot_date, fmt)
    parts = lambda: reshape.split_by_type(typed)  # noqa: E731  (filters prune to one type folder)
    return staging.Staging(lambda: parts()[0], lambda: parts()[1], lambda: parts()[2])


def read_quarantine(spark: SparkSession, staging_root: str, snapshot_date: str, fmt: str = "parquet") -> DataFrame:
    """``text, reason`` of the records of a date that did not parse (Q1)."""
    return reshape.quarantined(landing.stage_read_typed(spark, staging_root, snapshot_date, fmt))


def update_lake(spark: SparkSession, staging_root: str, lake_root: str, snapshot_date: str,
                selection: Sequence[str] = STAGING_TABLES, replace: bool = True,
                fmt: str = "parquet") -> list[str]:
    """Facts of the selected tables into ``<lake_root>/<table>_fact``.

    ``replace`` (default) overwrites only that date's partition, so re-runs
    are idempotent; ``replace=False`` appends, as the reference does.
    """
    facts = staging.to_facts(_read_staging(spark, staging_root, snapshot_date, fmt))
    outputs = {name: (lambda name=name: getattr(facts, name)) for name in STAGING_TABLES}
    write = writers.lake_replace if replace else writers.lake_append
    return writers.write_selected(
        outputs, selection, lambda name, make: write(make(), f"{lake_root}/{name}_fact", snapshot_date))


def update_warehouse(spark: SparkSession, staging_root: str, database: str, snapshot_date: str,
                     selection: Sequence[str] = STAGING_TABLES, location: str | None = None,
                     fmt: str = "parquet") -> list[str]:
    """Facts of the selected tables as catalog tables ``<database>.<table>_fact``."""
    facts = staging.to_facts(_read_staging(spark, staging_root, snapshot_date, fmt))
    outputs = {name: (lambda name=name: getattr(facts, name)) for name in STAGING_TABLES}
    return writers.write_selected(
        outputs, selection,
        lambda name, make: writers.warehouse_save(spark, make(), database, f"{name}_fact", location))

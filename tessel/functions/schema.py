"""Declared document schema and planning-time schema helpers.

A fundamentals document is one JSON object per entity::

    {"symbol": "...",
     "metric": {"<name>": <scalar>, ...},
     "series": {"annual":    {"<metric>": [{"period": "yyyy-MM-dd", "v": 1.0}, ...]},
                "quarterly": {"<metric>": [...]}}}

Parsing it with one declared, map-based schema keeps the plan's schema stable
whatever metrics a document carries, so every later step is a static plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

POINT = T.StructType([
    T.StructField("period", T.DateType()),
    T.StructField("v", T.DoubleType()),
])
POINTS = T.ArrayType(POINT)
SERIES = T.MapType(T.StringType(), T.MapType(T.StringType(), POINTS))
METRIC = T.MapType(T.StringType(), T.StringType())

DOC_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("metric", METRIC),
    T.StructField("series", SERIES),
])

# The two series frequencies and the staging frame type markers.
FREQS = ("annual", "quarterly")
TYPE_METRIC = "metric"
TYPE_QUARTERLY = "quarterly_metric"
TYPE_ANNUAL = "annual_metric"


# Keys of the column metadata that carry a staging column's group and metric.
# Metadata travels through projections, filters, joins and Parquet files, so
# no later step has to read a column's meaning out of its name.
GROUP, METRIC_NAME = "tessel.group", "tessel.metric"
QUARANTINE = "quarantine"
# Group of the columns that repeat a document's other top-level fields on each of its rows.
PASSTHROUGH = "passthrough"


def tagged(col: Column, name: str, group: str, metric: str) -> Column:
    return col.alias(name, metadata={GROUP: group, METRIC_NAME: metric})


def group_of(field: T.StructField) -> str | None:
    return (field.metadata or {}).get(GROUP)


def metric_of(field: T.StructField) -> str:
    return (field.metadata or {}).get(METRIC_NAME, field.name)


def unique_names(wanted: Sequence[str], taken: Sequence[str] = ()) -> list[str]:
    """The wanted column names; one that is taken, also in other case, gets
    ``metric_`` in front until it is free."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = f"metric_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def by_freq(series_metrics: Mapping[str, Sequence[str]] | Sequence[str]) -> dict[str, list[str]]:
    """Series metrics of each frequency; a plain list counts for every one."""
    if isinstance(series_metrics, Mapping):
        return {f: list(series_metrics.get(f, ())) for f in FREQS}
    return {f: list(series_metrics) for f in FREQS}


def require_columns(df: DataFrame, *cols: str) -> bool:
    """Column-presence guard."""
    return all(c in df.columns for c in cols)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Identity element for unions."""
    return spark.createDataFrame([], schema)


def quoted(name: str) -> str:
    """Backtick a column name so dots are never read as struct access."""
    return "`" + name.replace("`", "``") + "`"


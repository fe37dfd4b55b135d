"""Typed fact tables from the staging frames (F4: C1-C4).

Each fact is one ``select`` (one projection, however many columns), not a
chain of ``withColumn`` calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import to_date, to_float, to_string
from ..functions.schema import PASSTHROUGH, group_of, metric_of, quoted, unique_names

KEYS = ("date", "symbol")


def series_fact(staging: DataFrame, keep_source: bool = False) -> DataFrame:
    """``date`` -> date, ``symbol`` -> string, every other column -> float named
    after its metric, which the column's metadata tell (an untagged column keeps
    its name). A metric called like a key gets ``metric_`` in front.
    ``keep_source`` also keeps the source columns. A passed-through column stays as it is.
    """
    out = []
    passed = passed_through(staging)
    values = [f for f in staging.schema.fields if f.name not in KEYS and f.name not in passed]
    taken = [*KEYS, *passed, *(f.name for f in values if keep_source)]
    names = dict(zip((f.name for f in values), unique_names([metric_of(f) for f in values], taken)))
    for c in staging.columns:
        if c == "date":
            out.append(to_date(quoted(c)).alias("date"))
        elif c == "symbol":
            out.append(to_string(quoted(c)).alias("symbol"))
        elif c in passed:
            out.append(F.col(quoted(c)))
        else:
            if keep_source:
                out.append(F.col(quoted(c)))
            out.append(to_float(F.col(quoted(c))).alias(names[c]))
    return staging.select(*out)


def metric_fact(staging: DataFrame) -> DataFrame:
    """``symbol`` -> string, every metric -> float (non-numeric text -> null). A passed-through column stays as it is."""
    passed = passed_through(staging)
    return staging.select(*[
        to_string(quoted(c)).alias(c) if c == "symbol" else F.col(quoted(c)) if c in passed else to_float(quoted(c)).alias(c)
        for c in staging.columns
    ])


def passed_through(staging: DataFrame) -> set[str]:
    return {f.name for f in staging.schema.fields if group_of(f) == PASSTHROUGH}

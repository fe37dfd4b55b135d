"""Fact casts (C1-C5). ANSI mode is on, so anything that may be non-numeric
goes through ``try_cast`` and becomes null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_float(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("float")


def to_date(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("date")


def to_string(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def date_label(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Date formatting for partition labels."""
    return F.date_format(c, fmt)

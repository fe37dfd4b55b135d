"""The order in which column types widen, and casts along it.

Whole numbers widen by size, then to double (with any decimal or float), dates
to timestamps, and whatever has no common type otherwise to string. A column
without a type (``void``, JSON null) takes any other's.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole numbers by size, and the number types that meet in double.
WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType)
# The kinds of a variant's scalars and the column types that hold them.
VARIANT_TYPES = {"VOID": T.NullType(), "BOOLEAN": T.BooleanType(), "BIGINT": T.LongType(), "DECIMAL": T.DoubleType(),
                 "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "STRING": T.StringType(), "DATE": T.DateType(),
                 "TIMESTAMP": T.TimestampType(), "BINARY": T.StringType(), "UUID": T.StringType()}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds both; associative and commutative."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    number = lambda t: t in WHOLE or isinstance(t, FRACTIONS)
    if number(a) and number(b):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def widest(types: Iterable[T.DataType]) -> T.DataType:
    out: T.DataType = T.NullType()
    for t in types:
        out = wider(out, t)
    return out


def widened(fields: Iterable[tuple[str, T.DataType]]) -> dict[str, T.DataType]:
    """Types by column name, in order of first mention; a name without any type is a string."""
    out: dict[str, T.DataType] = {}
    for name, t in fields:
        out[name] = wider(out.get(name, T.NullType()), t)
    return {n: T.StringType() if isinstance(t, T.NullType) else t for n, t in out.items()}


def cast_to(col: Column, old: T.DataType, new: T.DataType) -> Column:
    """``col`` in a type that :func:`wider` gave; arrays, maps and structs become JSON text."""
    if old == new:
        return col
    if isinstance(old, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col.cast(new)

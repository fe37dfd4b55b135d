"""Documents of undeclared shape, as VARIANT values.

The declared parse (``functions.json``) knows ``symbol``, ``metric`` and
``series``. Here the whole document is a VARIANT, from which

* all other top-level fields travel losslessly as a map, and the scalar ones
  become typed columns of every metric and series row (P10);
* nested metric objects become flat metrics with dotted names, at any depth (P17);
* every path with its kinds is a table, from which the arrays of objects and
  their fields are read as data (P2, P3).

All of it is local to a row; what shuffles is a count per distinct path or
name, summed before the exchange. A JSON object with a repeated key is no
VARIANT and counts as malformed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import DOC_SCHEMA, quoted, unique_names
from ..functions.types import VARIANT_TYPES, widened

REST = "rest"
_NODES = "array<struct<k:string,v:variant>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where a lambda in ``body`` refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, VOID (a JSON null), ...; null without a value."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def fields(v: Column) -> Column:
    """An object's fields as a map; null for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


# --- P10: fields that no schema declares ---------------------------------------

def rest(doc: Column, declared: Sequence[str] = tuple(DOC_SCHEMA.names)) -> Column:
    """The top-level fields of a document besides the declared ones, whatever they hold."""
    return F.map_filter(fields(doc), lambda k, _: ~k.isin(list(declared)))


def scalar_fields(docs: DataFrame, name: str = REST) -> dict[str, T.DataType]:
    """Names of the scalars in the ``rest`` maps and the type that holds all their values; names that are never one are left out.

    One scan; the driver gets the distinct (name, kind) pairs.
    """
    each = docs.select(F.explode(name).alias("k", "v")).select("k", kind(F.col("v")).alias("kind"))
    found = sorted(map(tuple, each.filter(F.col("kind").isin(list(VARIANT_TYPES))).distinct().collect()))
    return widened((k, VARIANT_TYPES[t]) for k, t in found)


def with_scalars(docs: DataFrame, types: Mapping[str, T.DataType], name: str = REST, taken: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """``docs`` with a typed column per scalar field, and these columns' names (``metric_`` in front where one is taken)."""
    names = unique_names(list(types), [*docs.columns, *taken])
    value = lambda k, t: F.try_variant_get(F.col(quoted(name))[k], "$", t.simpleString())
    scalar = lambda k: kind(F.col(quoted(name))[k]).isin(list(VARIANT_TYPES))
    return docs.select("*", *[F.when(scalar(k), value(k, t)).alias(n) for n, (k, t) in zip(names, types.items(), strict=True)]), names


# --- P17: nested objects -> dotted names ---------------------------------------

def depth(df: DataFrame, v: Column) -> int:
    """Levels of objects and arrays in the deepest value; one aggregate, one number to the driver."""
    names = "`(?:[^`]|``)*`"  # a name may hold angle brackets
    brackets = F.split(F.regexp_replace(F.regexp_replace(F.schema_of_variant(v), names, ""), "[^<>]", ""), "")
    step = lambda a, c: let(a["at"] + F.when(c == "<", 1).when(c == ">", -1).otherwise(0), lambda at: F.struct(at.alias("at"), F.greatest(a["most"], at).alias("most")))
    most = F.aggregate(brackets, F.struct(F.lit(0).alias("at"), F.lit(0).alias("most")), step, lambda a: a["most"])
    return df.agg(F.max(most)).first()[0] or 0


def _entries(v: Column, name: Callable[[Column], Column]) -> Column:
    return F.transform(F.map_entries(fields(v)), lambda e: F.struct(name(e["key"]).alias("k"), e["value"].alias("v")))


def flat(v: Column, levels: int) -> Column:
    """Map of an object's scalars as text by dotted name, ``levels`` deep. Arrays and empty objects are left out; a JSON null is a null.

    Where a dotted name is also a field's own name, the lesser text stays.
    """
    nodes = F.coalesce(_entries(v, lambda k: k), F.array().cast(_NODES))
    for _ in range(levels - 1):
        nodes = F.flatten(F.transform(nodes, lambda e: F.coalesce(_entries(e["v"], lambda k: F.concat(e["k"], F.lit("."), k)), F.array(e))))
    leaves = F.filter(nodes, lambda e: e["v"].isNull() | ~kind(e["v"]).isin("OBJECT", "ARRAY"))
    texts = F.sort_array(F.transform(leaves, lambda e: F.struct(e["k"].alias("k"), e["v"].cast("string").alias("t"))))
    first = let(texts, lambda s: F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1)["k"] != x["k"])))
    return F.when(fields(v).isNotNull(), F.map_from_entries(first))


def flatten_metrics(docs: DataFrame, metric: str = "metric", levels: int | None = None) -> DataFrame:
    """``docs`` with the VARIANT column ``metric`` as the flat map of text that every metric operator takes."""
    v = F.col(metric)
    return docs.withColumn(metric, flat(v, levels or max(1, depth(docs, v))))


# --- P2, P3: paths as data ---------------------------------------------------------

def paths(docs: DataFrame, doc: str = "doc", levels: int | None = None) -> DataFrame:
    """``path, kind, docs``: every path below the documents, the kinds of values there, and how many documents have each.

    A path is the names from the top, joined by dots; ``[]`` after a name is an
    element of the array there. A path of conflicting kinds has a row for each.
    """
    v = F.col(doc)
    levels = levels or max(1, depth(docs, v))
    none = F.array().cast(_NODES)
    frame = docs.select(F.coalesce(_entries(v, lambda k: k), none).alias("n0"))
    for k in range(1, levels):
        below = lambda e: F.coalesce(
            _entries(e["v"], lambda k: F.concat(e["k"], F.lit("."), k)),
            F.transform(F.try_variant_get(e["v"], "$", "array<variant>"), lambda x: F.struct(F.concat(e["k"], F.lit("[]")).alias("k"), x.alias("v"))),
            none)
        frame = frame.select("*", F.flatten(F.transform(F.col(f"n{k - 1}"), below)).alias(f"n{k}"))
    seen = [F.array_distinct(F.transform(F.col(f"n{k}"), lambda e: F.struct(e["k"].alias("path"), F.coalesce(kind(e["v"]), F.lit("VOID")).alias("kind")))) for k in range(levels)]
    each = frame.select(F.inline(F.array_distinct(F.flatten(F.array(*seen)))))
    return each.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("docs"))


def object_arrays(found: DataFrame) -> DataFrame:
    """``path, docs`` of the arrays of objects, reached through objects alone."""
    rows = found.filter((F.col("kind") == "OBJECT") & F.col("path").endswith("[]"))
    return rows.select(F.expr("substr(path, 1, length(path) - 2)").alias("path"), "docs").filter(~F.contains("path", F.lit("[]")))


def array_fields(found: DataFrame) -> DataFrame:
    """``path, type, docs`` of the fields of those arrays' elements; the type holds all kinds found, ``docs`` is of its commonest kind."""
    rows = found.filter(F.regexp_like("path", F.lit(r"^[^\[]+\[\]\.[^.\[]+$")))
    kinds = rows.groupBy("path").agg(F.array_sort(F.collect_set("kind")).alias("kinds"), F.max("docs").alias("docs"))
    real = F.array_remove("kinds", "VOID")
    only = lambda *names: (F.size(real) > 0) & (F.size(F.array_except(real, F.array(*map(F.lit, names)))) == 0)
    merged = (F.when(only("BIGINT"), "bigint").when(only("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "double")
              .when(only("BOOLEAN"), "boolean").when(only("OBJECT"), "object").when(only("ARRAY"), "array").otherwise("string"))
    return kinds.select(F.replace("path", F.lit("[]"), F.lit("")).alias("path"), merged.alias("type"), "docs")

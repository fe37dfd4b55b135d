"""JSON text -> typed columns (S5), with bad-record isolation (Q1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import DOC_SCHEMA, METRIC

# Reader options of the document ingest.
JSON_OPTIONS = {
    "multiLine": "true",
    "mode": "PERMISSIVE",
    "dateFormat": "yyyy-MM-dd",
    "allowSingleQuotes": "true",
}

# The same for text that is one value a row already.
JSON_ALONE = {k: v for k, v in JSON_OPTIONS.items() if k != "multiLine"}

CORRUPT = "_corrupt_record"


def parse_json(text: Column | str, schema: T.StructType | str, options: dict | None = None) -> Column:
    """``from_json`` with the ingest options; malformed text gives null fields."""
    return F.from_json(text, schema, {**JSON_ALONE, **(options or {})})


def parsed_once(df: DataFrame, keep: list[str], parsed: Column, name: str) -> DataFrame:
    """``keep`` columns plus the struct ``parsed`` as column ``name``, through a
    one-element generator.

    Catalyst pushes filters below projections by substituting aliases, which
    would copy an expensive parse into every predicate that touches it (the
    text would be parsed once per reference). A generator's output cannot be
    substituted, so the parse runs exactly once per row and later filters stay
    above it.
    """
    return df.select(*keep, F.inline(F.array(F.struct(parsed.alias(name)))))


def parse_documents(texts: DataFrame, col: str = "doc", fields: Sequence[str] | None = None, flagged: bool = False) -> DataFrame:
    """Document text -> ``symbol, metric, series`` (declared schema, no inference).

    ``fields``: only these of the declared fields are parsed. ``flagged`` adds
    ``_corrupt_record``, the text of what is no JSON object; without it such
    text gives a row of nulls.
    """
    schema = T.StructType([f for f in DOC_SCHEMA.fields if fields is None or f.name in fields])
    if not flagged:
        return parsed_once(texts, [], parse_json(F.col(col), schema), "_d").select("_d.*")
    noted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = parsed_once(texts, [], parse_json(F.col(col), noted, {"columnNameOfCorruptRecord": CORRUPT}), "_d").select("_d.*")
    return parsed.withColumn(CORRUPT, malformed(F.col(CORRUPT)))


def malformed(corrupt: Column) -> Column:
    """The text in a reader's corrupt-record column if it is no JSON object.

    The column is also set where a single value does not fit its declared type;
    the reader has made a null of that value alone and kept the rest.
    """
    return F.when(corrupt.isNotNull() & F.json_object_keys(corrupt).isNull(), corrupt)


# The declared document with its leaves as text, and with its fields as they come.
_LEAVES = T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(
    T.StructType([T.StructField("period", T.StringType()), T.StructField("v", T.StringType())]))))
_AS_TEXT = T.StructType([T.StructField("metric", T.StringType()), T.StructField("series", T.StringType())])


def bad_values(corrupt: Column) -> Column:
    """How many values of a flagged record did not fit (0 where nothing is flagged): points whose period is no date or
    whose v is no number, and fields of another shape than declared. The text is parsed again, for flagged records only."""
    fields = F.from_json(corrupt, _AS_TEXT, JSON_ALONE)
    leaves = F.from_json(fields["series"], _LEAVES, JSON_ALONE)
    points = F.flatten(F.flatten(F.transform(F.map_values(leaves), lambda m: F.map_values(m))))
    bad = lambda p: (p["period"].isNotNull() & p["period"].try_cast("date").isNull()).cast("int") + (
        p["v"].isNotNull() & p["v"].try_cast("double").isNull()).cast("int")
    count = F.aggregate(F.coalesce(points, F.array().cast("array<struct<period:string,v:string>>")), F.lit(0), lambda n, p: n + F.coalesce(bad(p), F.lit(0)))
    shape = lambda name, parsed: (fields[name].isNotNull() & parsed.isNull()).cast("int")
    shapes = shape("metric", F.from_json(fields["metric"], METRIC, JSON_ALONE)) + shape("series", leaves)
    return F.when(corrupt.isNotNull() & malformed(corrupt).isNull(), F.greatest(F.lit(1), count + shapes)).otherwise(F.lit(0))


def with_quarantine(df: DataFrame, text_col: str, schema: T.StructType) -> DataFrame:
    """Parse ``text_col`` keeping the raw text of malformed records.

    Adds ``parsed`` (struct) and ``reason`` (null when the record is fine; a
    value that does not fit its type is a null in a fine record).
    Bad records are flagged, never dropped; callers split on ``reason``.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = parse_json(F.col(text_col), with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    out = parsed_once(df, df.columns, parsed, "_p")
    reason = (F.when(F.col(text_col).isNull(), F.lit("null input"))
              .when(malformed(F.col(f"_p.{CORRUPT}")).isNotNull(), F.lit("malformed json")))
    return out.select(
        *df.columns,
        F.struct(*[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields]).alias("parsed"),
        reason.alias("reason"),
    )

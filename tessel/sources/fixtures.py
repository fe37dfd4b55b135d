"""Fundamentals documents derived from the driver tables.

Suppliers play the entities (``symbol = s_name``); their lineitems give one
annual and one quarterly series per metric; supplier attributes give the flat
``metric`` object. The derivation is a Spark plan that grows with lineitem:

1. one aggregation of lineitem on ``(supplier, quarter)``, partial (map-side)
   before its shuffle, with exact fixed-point sums;
2. one shuffle of that small result on supplier, after which the annual
   roll-up and the nested ``series`` map (conditional ``collect_list``) run
   without further exchanges; a supplier's group is bounded by its number of
   periods, not by its number of lineitems;
3. a sort-merge join to ``supplier`` for the metric row (only the supplier
   side moves; the per-supplier side keeps its partitioning).

A hot supplier holding a third of lineitem is collapsed by the partial
aggregation before any row leaves its map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import DOC_SCHEMA, FREQS
from ..operators.series import sql_ident, sql_str
from ..session import per_entity_partitions as _per_entity_partitions
from .tables import table

# The series metrics of the derived documents (sorted) and the
# keys of their flat metric object (sorted).
SERIES_METRICS = ("quantity", "returned", "sales")
METRIC_KEYS = ("firstShip", "s_acctbal", "s_nationkey")
# What counts as a large return, of which many suppliers have none, one or a few.
LARGE_QUANTITY, LARGE_DISCOUNT = 48, 0.1


def cents(c: Column | str) -> Column:
    """Exact fixed-point hundredths as a long: sums of these are associative,
    so quarterly partial sums roll up to exactly the annual sums (and stay on
    Spark's fast long aggregation path, unlike wide decimals)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c * 100).cast("bigint")


def series_periods(spark: SparkSession, sf_dir: str, large_returns: bool = False) -> DataFrame:
    """Per supplier, frequency and period: metric sums and first ship date, of all line items or of the large returns.

    Columns: suppkey, freq, period, quantity, returned, sales (doubles),
    first_ship; hash-partitioned by ``suppkey``.

    Plan: one scan of lineitem; partial aggregation on ``(supplier, quarter)``
    before the first shuffle; each quarter row is then sent to its quarter and
    to its year, and the small result is repartitioned by supplier once. The
    roll-up aggregation (and the per-supplier step that follows) reuse that
    partitioning, so no further exchange is planned. The sums are fixed-point
    longs, so the annual roll-up equals a direct annual sum exactly.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    day = F.to_date("l_shipdate")
    qty = cents("l_quantity")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.08)
    if large_returns:
        li = li.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= LARGE_QUANTITY) & (F.col("l_discount") >= LARGE_DISCOUNT))
    quarterly = li.groupBy(F.col("l_suppkey").alias("suppkey"), F.trunc(day, "quarter").alias("quarter")).agg(
        F.sum(qty).alias("qty"), F.sum(F.when(returned, qty)).alias("ret"),
        F.sum(cents("l_extendedprice")).alias("price"), F.min(day).alias("first_ship"),
    )
    both = quarterly.select(
        "suppkey", "qty", "ret", "price", "first_ship",
        F.inline(F.array(
            F.struct(F.lit("quarterly").alias("freq"), F.col("quarter").alias("period")),
            F.struct(F.lit("annual").alias("freq"), F.trunc("quarter", "year").alias("period")),
        )),
    ).repartition(_per_entity_partitions(spark), "suppkey")
    rolled = both.groupBy("suppkey", "freq", "period").agg(
        F.sum("qty").alias("qty"), F.sum("ret").alias("ret"), F.sum("price").alias("price"),
        F.min("first_ship").alias("first_ship"),
    )
    return rolled.select("suppkey", "freq", "period",
                         (F.col("qty") / 100).alias("quantity"), (F.col("ret") / 100).alias("returned"),
                         (F.col("price") / 100).alias("sales"), "first_ship")


def _per_supplier(per: DataFrame) -> DataFrame:
    """One row per supplier with its nested ``series`` map.

    One conditional ``collect_list`` per (freq, metric): the group of a
    supplier holds one row per period, so it is bounded by the number of
    periods, not by the supplier's lineitems. Empty arrays and empty
    frequencies are dropped, as in the landed documents. The expressions are
    Spark SQL text, so each crosses to the JVM in one call.
    """
    aggs = [F.expr("min(first_ship)").alias("first_ship")]
    for f in FREQS:
        for m in SERIES_METRICS:
            aggs.append(F.expr(
                f"collect_list(CASE WHEN freq = {sql_str(f)} AND {sql_ident(m)} IS NOT NULL "
                f"THEN named_struct('period', period, 'v', {sql_ident(m)}) END)").alias(f"{f}_{m}"))
    by_freq = []
    for f in FREQS:
        inner = ", ".join(f"{sql_str(m)}, sort_array({sql_ident(f + '_' + m)}, false)" for m in SERIES_METRICS)
        by_freq.append(f"{sql_str(f)}, map_filter(map({inner}), (_k, _a) -> size(_a) > 0)")
    series = F.expr(f"map_filter(map({', '.join(by_freq)}), (_k, _m) -> size(_m) > 0)")
    return per.groupBy("suppkey").agg(*aggs).select("suppkey", "first_ship", series.alias("series"))


def documents(spark: SparkSession, sf_dir: str, gappy: bool = False) -> DataFrame:
    """Parsed-shape documents: suppkey, symbol, metric, series.

    ``gappy``: documents of the large returns alone. A supplier without any
    publishes no series (null), one with a single quarter of them annual series
    only; every supplier keeps its document.
    """
    per_supplier = _per_supplier(series_periods(spark, sf_dir, gappy))
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    # Sort-merge on suppkey: the per-supplier side is already partitioned by
    # it, so only the supplier side moves, and the per-document work after the
    # join runs in as many tasks as the per-supplier aggregate has partitions.
    joined = sup.join(per_supplier.hint("merge"), sup.s_suppkey == per_supplier.suppkey, "left")
    metric = F.expr("map('firstShip', date_format(first_ship, 'yyyy-MM-dd'), "
                    "'s_acctbal', CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS STRING), "
                    "'s_nationkey', CAST(s_nationkey AS STRING))")
    series = F.col("series")
    if gappy:
        quarters = F.size(F.array_distinct(F.transform(F.flatten(F.map_values(series["quarterly"])), lambda p: p["period"])))
        series = F.when(quarters < 2, F.map_filter(series, lambda key, _: key != "quarterly")).otherwise(series)
    return joined.select(
        F.col("s_suppkey").alias("suppkey"),
        F.col("s_name").alias("symbol"),
        metric.alias("metric"),
        series.alias("series"),
    )


def document_text(spark: SparkSession, sf_dir: str, gappy: bool = False) -> DataFrame:
    """The landed form: one JSON text per entity in column ``doc``."""
    d = documents(spark, sf_dir, gappy)
    return d.select(F.to_json(F.struct("symbol", "metric", "series")).alias("doc"))

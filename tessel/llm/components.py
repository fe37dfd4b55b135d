"""Connected components by alternating stars.

Kiveris et al., "Connected components in MapReduce and beyond" (2014): the
large star links every greater neighbour of a node to the least node near it,
the small star does so for the lesser ones; both keep the components and soon
leave one star per component. All of it is joins and aggregates on the edges;
each round is written to the shared scratch folder, and only a count and a
hash of the edges come to the driver. A node with many neighbours is a skewed
join key, whose minimum is aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _large(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root: least node of its component) of every node with an edge to another; node ids are non-null longs."""
    e = settle(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "cc")
    mark = None
    while True:
        e = settle(_small(_large(e)), "cc")
        now = _mark(e)
        if now == mark or not now[0]:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

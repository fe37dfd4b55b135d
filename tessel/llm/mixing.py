"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Every source gets a target: the total is shared by weight, and no target
   exceeds ``most`` times its source's size (water filling).
2. The targets are apportioned in blocks of equal token counts: each block goes
   to the source with the highest quotient ``target / (2 * blocks + 1)``.
3. A source's documents are dealt over shards by a seeded hash of id and text.
   A shard's tokens are cut into whole blocks of equal size, as near to the
   block size as goes. The source's quota, restated in these blocks, is
   apportioned over its shards by the same quotients of their blocks, which
   gives every shard an integer quota. No quota exceeds ``most`` times the
   shard's blocks, as the highest quotients never give more, so no seat is lost.
4. Within a shard the documents stand in a seeded order and form one stream of
   tokens, cut into blocks of equal size. The quota takes every block
   ``quota div blocks`` times, and the rest as a run of blocks from a seeded
   starting block on, cyclically. As the documents stand in random order, a run
   of blocks is a random choice of documents, and it cuts two of them at most.

The highest quotients are found without listing all of them: at the divisor
``total / (blocks - sources / 2)`` the rounded shares sum to at most the blocks,
and only the few quotients between that divisor and
``total / (blocks + sources / 2)`` are ranked. Everything is arithmetic over
running sums; a source with a third of all rows is many shards. Their number and
their documents both grow with the square root of the source's documents, so
that neither the shards of a source nor the documents of a shard, which are
window groups, outgrow the other. The tables of sources and of shards are small
next to the documents.

Block size: ``block`` tokens, less if a small source's target is under
``per_source`` blocks. A shard has about ``shard_blocks`` blocks or more, so that
rounding it to whole blocks moves what it takes by half a hundredth at most; a
source too small for that is one shard.

Edge cases: null text or no words is size 0 and takes nothing; null is a source
of its own, last in order; repeated rows are documents of their own (equal rows
are interchangeable, and meet in one shard); rows without an id or with one id
are dealt by their texts; an empty table gives an empty result; all sizes 0 give
targets 0; other columns pass
through within the row, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settle, whole, words


@dataclass(frozen=True)
class Mix:
    weights: Sequence[int] = (3, 1, 2)  # by code point of the source, repeating
    share: float = 1.5  # of all sizes
    most: int = 2  # times a source's size
    block: int = 256
    per_source: int = 200
    shard_docs: int = 64
    shard_blocks: int = 100
    seed: str = "mix"


def _digest(*cols: Column) -> Column:
    return F.md5(F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols]))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, m: Mix) -> DataFrame:
    """Adds ``target`` and ``block`` to the sources (src, source_size, docs).

    At the level where source i is just capped, the sum of all targets is
    ``f(i)``; the capped ones are those with ``f(i) <= total``.
    """
    rank = F.row_number().over(W.orderBy(F.col("src").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in m.weights]), F.pmod(rank - 1, F.lit(len(m.weights))) + 1)
    every, upto = W.partitionBy(), W.orderBy("ratio", F.col("src").asc_nulls_last())
    rows = sources.withColumn("w", weight).withColumn("cap", (m.most * F.col("source_size")).cast("double")).withColumn("ratio", F.col("cap") / F.col("w"))
    rows = rows.withColumn("total", m.share * F.sum("source_size").over(every))
    before = F.coalesce(F.sum("cap").over(upto.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(upto.rowsBetween(W.currentRow, W.unboundedFollowing))
    rows = rows.withColumn("full", before + F.col("ratio") * rest <= F.col("total"))
    spent = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)
    sharing = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(every)
    rows = rows.withColumn("target", F.when(F.col("full") | (sharing == 0), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("w") * (F.col("total") - spent) / sharing)))
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(every)
    return rows.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(m.block), F.floor(F.coalesce(least, F.lit(1.0)) / m.per_source))).cast("long")).drop("w", "cap", "ratio", "total", "full")


def apportion(rows: DataFrame, share: str, seats: Column, by: list[str], key: list[str], name: str) -> DataFrame:
    """Adds ``name``: each row's seats by highest quotients ``share / (2k + 1)``; ties by ``key``.

    ``seats`` is equal for all rows of a group ``by``; ``key`` tells its rows apart.
    """
    group = W.partitionBy(*by)
    rows = rows.withColumn("_n", seats.cast("double")).withColumn("_sum", F.sum(share).over(group)).withColumn("_half", F.count("*").over(group) / 2)
    some = (F.col(share) > 0) & (F.col("_sum") > 0)
    low = F.when(some & (F.col("_n") > F.col("_half")), F.floor(F.col(share) * (F.col("_n") - F.col("_half")) / F.col("_sum") + 0.5)).otherwise(0).cast("long")
    high = F.when(some, F.ceil(F.col(share) * (F.col("_n") + F.col("_half")) / F.col("_sum") + 0.5)).otherwise(0).cast("long")
    # one seat lower and higher against rounding
    rows = rows.withColumn("_low", F.greatest(F.lit(0), low - 1)).withColumn("_left", (F.col("_n") - F.sum(F.greatest(F.lit(0), low - 1)).over(group)).cast("long")).withColumn("_high", high + 1)
    tied = [F.col(k).asc_nulls_last() for k in key]
    seat = rows.filter(F.col(share) > 0).select(*by, *key, F.col(share).alias("_t"), "_left", F.explode(F.sequence("_low", "_high")).alias("_k"))
    won = seat.withColumn("_r", F.row_number().over(group.orderBy((F.col("_t") / (2 * F.col("_k") + 1)).desc(), *tied, "_k"))).filter(F.col("_r") <= F.col("_left"))
    more = won.groupBy(*by, *key).agg(F.count("*").alias("_more"))
    r, q = rows.alias("r"), more.alias("q")
    same = None
    for c in [*by, *key]:
        e = F.col(f"r.{c}").eqNullSafe(F.col(f"q.{c}"))
        same = e if same is None else same & e
    got = F.col("r._low") + F.coalesce("q._more", F.lit(0))
    keep = [F.col(f"r.{c}") for c in rows.columns if c not in ("_n", "_sum", "_half", "_low", "_left", "_high")]
    return r.join(q, same, "left").select(*keep, got.cast("long").alias(name))


def mix(docs: DataFrame, doc_id: Column, source: Column, size: Column, text_hash: Column, m: Mix = Mix()) -> DataFrame:
    """(row, plan): every row of ``docs`` as a struct, and what the mix takes of it.

    ``text_hash`` tells texts of one id apart.

    plan: size, source_size, target, copies (whole), the run's part of the
    document as tokens a0 to a1 and, if the run wraps, 0 to b1 (ends exclusive), and taken.
    """
    docs = docs.select(F.struct("*").alias("row"), doc_id.alias("_id"), source.alias("_source"), size.cast("long").alias("_size"), text_hash.alias("_text"))
    per_source = docs.groupBy(F.col("_source").alias("src")).agg(F.sum("_size").alias("source_size"), F.count("*").alias("docs"))
    sources = targets(settle(per_source, "mix-sources"), m)
    seats = F.round(F.sum("target").over(W.partitionBy()) / F.col("block"))
    sources = apportion(sources.withColumn("_all", seats), "target", F.col("_all"), [], ["src"], "quota").drop("_all")
    by_docs = F.least(F.ceil(F.col("docs") / m.shard_docs), F.ceil(4 * F.sqrt("docs")))
    shards = F.greatest(F.lit(1), F.least(by_docs, F.floor(F.col("source_size") / (m.shard_blocks * F.col("block")))))
    sources = settle(sources.withColumn("shards", shards.cast("long")), "mix-quotas")
    few = sources.count() <= 10_000  # a name and a few numbers each: proven small before it is broadcast

    def placed(rows: DataFrame) -> DataFrame:
        """With the source's figures and the document's shard, on the seeded digest of its id and text."""
        joined = rows.join(sources.hint("broadcast") if few else sources, F.col("_source").eqNullSafe(F.col("src")))
        return joined.withColumn("_h", _digest(F.lit(m.seed), F.col("_id"), F.col("_text"))).withColumn("_shard", F.pmod(_number(F.col("_h")), F.col("shards")))

    per_shard = placed(docs.drop("row")).groupBy("src", "_shard", "quota", "block", "source_size").agg(F.sum("_size").alias("shard_size"))
    blocks = F.when(F.col("shard_size") > 0, F.greatest(F.lit(1), F.round(F.col("shard_size") / F.col("block")))).otherwise(0).cast("long")
    shards = settle(per_shard.withColumn("blocks", blocks), "mix-shards")
    every = F.sum("blocks").over(W.partitionBy("src"))
    seats = F.least(m.most * every, F.when(every > 0, F.round(F.col("quota") * F.col("block") * every / F.col("source_size"))).otherwise(0))
    shards = apportion(shards.withColumn("seats", seats), "blocks", F.col("seats"), ["src"], ["_shard"], "q").filter("blocks > 0")
    shards = shards.withColumn("first", F.pmod(_number(_digest(F.lit(m.seed), F.col("src"), F.col("_shard"))), F.col("blocks")))
    cut = lambda j: F.floor(j * F.col("shard_size") / F.col("blocks")).cast("long")
    end = F.col("first") + F.pmod("q", "blocks")
    shards = settle(shards.select(
        F.col("src").alias("_s"), F.col("_shard").alias("_k"), F.floor(F.col("q") / F.col("blocks")).cast("long").alias("copies"),
        cut(F.col("first")).alias("r0"), cut(F.least(end, F.col("blocks"))).alias("r1"), cut(F.greatest(F.lit(0), end - F.col("blocks"))).alias("w1")), "mix-shard-quotas")

    order = W.partitionBy("src", "_shard").orderBy("_h", F.col("_id").asc_nulls_first(), "_text", "_size")
    stream = placed(docs).withColumn("_end", F.sum("_size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    both = stream.join(shards, F.col("src").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_k")), "left")
    begin = F.col("_end") - F.col("_size")
    inside = lambda x: F.least(F.greatest(x - begin, F.lit(0)), F.col("_size")).cast("long")
    none = F.lit(0).cast("long")  # a shard without a word has no blocks
    a0, a1, b1, copies = (F.coalesce(c, none) for c in (inside(F.col("r0")), inside(F.col("r1")), inside(F.col("w1")), F.col("copies")))
    taken = copies * F.col("_size") + (a1 - a0) + b1
    return both.select("row", F.struct(
        F.col("_size").alias("size"), "source_size", "target", copies.alias("copies"), a0.alias("a0"), a1.alias("a1"), b1.alias("b1"), taken.cast("long").alias("taken")).alias("plan"))


def realise(mixed: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """The mixed documents: one row per whole copy, and one per cut part, whose text is its words joined by single spaces.

    A part that is the whole document keeps its text. Rows of size 0 are taken by no block and are left out.
    """
    p = F.col("plan")
    body = whole(F.col("row").getField(text))
    w = words(body)
    part = lambda a, b: F.when(b - a == p["size"], body).otherwise(F.array_join(F.slice(w, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")), " "))
    texts = F.concat(
        F.array_repeat(body, F.when(p["size"] > 0, p["copies"]).otherwise(0).cast("int")),
        F.when(p["a1"] > p["a0"], F.array(part(p["a0"], p["a1"]))).otherwise(F.array().cast("array<string>")),
        F.when(p["b1"] > 0, F.array(part(F.lit(0).cast("long"), p["b1"]))).otherwise(F.array().cast("array<string>")))
    rows = mixed.select("row", F.explode(texts).alias("body"))
    return rows.select(*[F.col("body").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns])

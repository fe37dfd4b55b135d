"""Source divergence audit by sorting pointers to the starts of words.

A shard is a few MB of texts in one Arrow buffer. Its words are not cut out:
an array holds the place of every word's first byte, and a multikey quicksort
orders these pointers by the bytes behind them, eight at a time. A slice of
pointers that agree so far is sorted by its next eight bytes (up to the word's
end), and every run of equal ones is a slice of the next round; a run that has
reached its words' end is one term. Within a run, the pointers' documents give
the term's document frequency and its occurrences by source. A shard emits one
row per term and (lang, source); Spark adds these up and does the rest.

Shards are cut by bytes as a task's batches arrive, so memory does not follow
the partition's size. A text longer than a shard is sorted in pieces that end
between words; a set of its terms keeps it one document of each.

With the kept terms of a language (in at least ``least`` of its documents) and
the counts of each of its sources, :func:`audit` scales smoothed relative
frequencies to whole numbers, and gives the distance of every two sources of a
language and the terms that most set a source apart from its language. All
arithmetic is on longs and decimals, so results do not depend on partitioning.

Distances are sums over all kept terms, those absent from both sources too.
They are added up over buckets of about TERMS terms, for two blocks of at most
BLOCK sources at a time: a task holds about ENTRIES numbers at most, however
frequent a term or large a language or source. The result itself has a row for
each two sources of a language.

Edge cases: null text, lang and source count as empty; a group without terms
has its rows; a language without kept terms has distances of 0 and no term
rows; equal values are ranked by the item's bytes; rows of one id are documents of
their own, as is each repeated row; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, settle, whole

#: By byte: part of a word (letters, and all bytes of code points beyond ASCII); lower case of A-Z.
INSIDE = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: The first k of eight bytes.
FIRST = np.array([(1 << 64) - (1 << 64 - 8 * k) for k in range(9)], np.uint64)
#: Bytes of a shard; bytes from which on the rest of a word is compared as one string.
SHARD, DEEP = 8 << 20, 64
#: Sources of a block; terms of a bucket, fewer where a cell would have over ENTRIES numbers.
BLOCK, TERMS, ENTRIES = 512, 2048, 1 << 21
COUNTS = "lang string, source string, term string, docs long, count long"


def word_pointers(body: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words' first bytes, and their lengths. ``bounds``: where texts begin and end; no word crosses one."""
    inside = INSIDE[body]
    edge = np.zeros(len(body) + 1, bool)
    edge[bounds] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    at = np.flatnonzero(first)
    return at, np.flatnonzero(last) + 1 - at


def sort_pointers(folded: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the pointers in order of their words, and whether each begins a run of equal ones.

    ``folded`` has eight bytes more than the text.
    """
    eight = np.lib.stride_tricks.sliding_window_view(folded, 8)

    def key(p: np.ndarray, depth: int) -> np.ndarray:
        left = np.clip(size[p] - depth, 0, 8)
        ahead = np.ascontiguousarray(eight[np.minimum(at[p] + depth, len(eight) - 1)]).view(">u8").ravel().astype(np.uint64)
        return ahead & FIRST[left]

    k = key(np.arange(len(at)), 0)
    order = np.argsort(k)
    k = k[order]
    new = np.ones(len(at), bool)
    new[1:] = k[1:] != k[:-1]
    act, depth = np.arange(len(at)), 8
    while act.size:
        # of the slices sorted last, those go on that have several pointers and words that go on
        starts = np.flatnonzero(new[act])
        sizes = np.diff(np.append(starts, act.size))
        on = (np.maximum.reduceat(size[order[act]], starts) > depth) & (sizes > 1)
        act = act[np.repeat(on, sizes)]
        if not act.size:
            break
        piece = np.repeat(np.arange(int(on.sum())), sizes[on])
        if depth >= DEEP:
            rest = [(s, folded[at[p] + depth : at[p] + size[p]].tobytes()) for s, p in zip(piece.tolist(), order[act].tolist(), strict=True)]
            by = sorted(range(len(rest)), key=rest.__getitem__)
            order[act] = order[act][by]
            new[act[1:]] = [rest[a] != rest[b] for a, b in zip(by, by[1:])]
            break
        k = key(order[act], depth)
        by = np.lexsort((k, piece))
        order[act], k = order[act][by], k[by]
        new[act[1:]] |= k[1:] != k[:-1]
        depth += 8
    return order, new


def runs(body: np.ndarray, bounds: np.ndarray, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(term, group, documents, occurrences) of a shard: texts between ``bounds``, each of a group."""
    at, size = word_pointers(body, bounds)
    if not len(at):
        return pa.array([], pa.string()), *[np.zeros(0, np.int64)] * 3
    folded = np.zeros(len(body) + 8, np.uint8)
    folded[: len(body)] = FOLD[body]
    order, new = sort_pointers(folded, at, size)
    # documents numbered by group, so that one sort puts a run's documents in order of their groups
    by_group = np.argsort(group, kind="stable")
    number = np.empty(len(group), np.int64)
    number[by_group] = np.arange(len(group))
    of = number[np.searchsorted(bounds, at, "right") - 1]
    run = np.cumsum(new) - 1
    pairs = np.sort(run * len(group) + of[order])
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    times = np.diff(np.append(first, len(pairs)))
    run, group = pairs[first] // len(group), group[by_group][pairs[first] % len(group)]
    cut = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (group[1:] != group[:-1])))
    docs, count = np.diff(np.append(cut, len(run))), np.add.reduceat(times, cut)
    # the runs' words, from the first pointer of each
    p = order[new]
    ends = np.cumsum(size[p])
    places = np.repeat(at[p] - (ends - size[p]), size[p]) + np.arange(ends[-1])
    terms = pa.LargeStringArray.from_buffers(len(p), pa.py_buffer(np.append(0, ends)), pa.py_buffer(folded[places]))
    return terms.take(pa.array(run[cut])).cast(pa.string()), group[cut], docs, count


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    d = column.dictionary_encode()
    return d.indices.to_numpy().astype(np.int64), d.dictionary


def shard_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Counts of one shard, of columns lang, source, text."""
    lang, langs = _codes(batch.column("lang"))
    source, sources = _codes(batch.column("source"))
    group = lang * max(1, len(sources)) + source
    texts = batch.column("text").cast(pa.large_string())
    _, places, body = texts.buffers()
    bounds = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    bytes_ = np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]] if body else np.zeros(0, np.uint8)

    def out(terms: pa.Array, g: np.ndarray, docs: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        of = langs.take(pa.array(g // max(1, len(sources)))), sources.take(pa.array(g % max(1, len(sources))))
        return pa.RecordBatch.from_arrays([*of, terms, pa.array(docs.astype(np.int64)), pa.array(count.astype(np.int64))], ["lang", "source", "term", "docs", "count"])

    if len(bytes_) <= SHARD or len(texts) > 1:
        yield out(*runs(bytes_, bounds - bounds[0], group))
        return
    seen: set[str] = set()  # of one text longer than a shard
    at = 0
    while at < len(bytes_):
        end = min(at + SHARD, len(bytes_))
        while end < len(bytes_) and INSIDE[bytes_[end]]:
            ahead = np.flatnonzero(~INSIDE[bytes_[end : end + SHARD]])
            end = end + int(ahead[0]) if len(ahead) else min(end + SHARD, len(bytes_))
        terms, g, docs, count = runs(bytes_[at:end], np.array([0, end - at]), group)
        fresh = np.array([t not in seen for t in terms.to_pylist()], np.int64)
        seen.update(terms.to_pylist())
        yield out(terms, g, docs * fresh, count)
        at = end


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most SHARD bytes of text; a longer text alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        ends = np.cumsum(pa.compute.binary_length(b.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            base = int(ends[at - 1]) if at else 0
            until = int(np.searchsorted(ends, base + SHARD - size, "right"))
            if until > at:
                held.append(b.slice(at, until - at))
                size += int(ends[until - 1]) - base
                at = until
            elif held:
                yield _joined(held)
                held, size = [], 0
            else:
                yield b.slice(at, 1)
                at += 1
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    large = pa.schema([("lang", pa.large_string()), ("source", pa.large_string()), ("text", pa.large_string())])
    return pa.Table.from_batches(parts).cast(large).combine_chunks().to_batches()[0]


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, docs, count) over all texts."""
    rows = docs.select(whole(lang).alias("lang"), whole(source).alias("source"), whole(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in shards(batches):
            for b in shard_rows(s):
                for at in range(0, b.num_rows, 50_000):
                    yield b.slice(at, 50_000).cast(pa.schema([*[(c, pa.string()) for c in ("lang", "source", "term")], ("docs", pa.int64()), ("count", pa.int64())]))

    per_shard = rows.mapInArrow(run, COUNTS)
    return per_shard.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))


def scaled(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (n + 5 v)), exactly; null without terms."""
    wide = lambda c: c.cast("decimal(38,0)")
    quotient = F.call_function("div", wide(F.lit(1_000_000_000)) * wide(count + 5), wide(n + 5 * v))
    return F.when(v > 0, 1 + quotient)


def audit(docs: DataFrame, least: int = 30, top: int = 50, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): see the module's docstring."""
    counts = settle(term_counts(docs, lang, source, text), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("total"))
    kept = settle(kept.filter(F.col("docs") >= least).drop("docs"), "kept-terms")
    used = settle(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    everyone = docs.select(whole(lang).alias("lang"), whole(source).alias("source")).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_docs")).drop("n_docs")
    sizes = used.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = everyone.join(sizes, ["lang", "source"], "left").join(languages, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "lang_n")])
    groups = groups.withColumn("absent", F.coalesce(scaled(F.lit(0).cast("long"), F.col("n"), F.col("v")), F.lit(0)))
    by_lang = W.partitionBy("lang")
    groups = groups.withColumn("no", F.row_number().over(by_lang.orderBy("source")) - 1).withColumn("sources", F.count(F.lit(1)).over(by_lang))
    groups = settle(groups, "groups")
    p = scaled(F.col("count"), F.col("n"), F.col("v"))
    scored = used.join(broadcast_if_small(groups), ["lang", "source"]).withColumn("p", p)

    apart = scored.withColumn("value", F.col("p") - scaled(F.col("total"), F.col("lang_n"), F.col("v"))).filter("value > 0")
    terms = _ranked(apart.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")).filter(F.col("rank") <= top)
    return _ranked(distances(groups, scored)).unionByName(terms)


def _ranked(rows: DataFrame) -> DataFrame:
    order = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank"))


def distances(groups: DataFrame, scored: DataFrame) -> DataFrame:
    """Sum over a language's kept terms of the difference of p, for every two sources, both ways."""
    wide = F.least(F.col("sources"), F.lit(2 * BLOCK))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("v") / F.least(F.lit(float(TERMS)), ENTRIES / wide))).cast("int")
    block = F.floor(F.col("no") / BLOCK).cast("int")
    blocks = F.ceil(F.col("sources") / BLOCK).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    cells = ["lang", "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    each = F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket")
    base = groups.select("lang", "source", "no", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"), block.alias("block"), blocks.alias("blocks"), each)
    base = base.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    there = scored.select("lang", F.lit(None).cast("string").alias("source"), "no", "term", "p", block.alias("block"), F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), other)
    columns = [*cells, "block", "source", "no", "term", "p"]
    rows = base.select(*columns).unionByName(there.select(*columns))

    def added(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        i, j = key[2], key[3]
        known = cell["term"].notna()
        head = cell[~known].sort_values("no")
        number = pd.Series(np.arange(len(head)), head["no"].to_numpy())
        code, terms = pd.factorize(cell["term"][known])
        p = np.repeat(head["p"].to_numpy(np.int64)[:, None], len(terms), 1)
        p[number[cell["no"][known]].to_numpy(), code] = cell["p"][known].to_numpy(np.int64)
        block, source = head["block"].to_numpy(), head["source"].to_numpy()
        out = []
        for a in np.flatnonzero(block == i).tolist():
            b = np.flatnonzero(block == j)
            b = b[b > a]
            out.append(pd.DataFrame({"lang": key[0], "a": source[a], "b": source[b], "value": np.abs(p[b] - p[a]).sum(1)}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "a": [], "b": [], "value": []})

    partial = rows.groupBy("lang", "bucket", "i", "j").applyInPandas(added, "lang string, a string, b string, value long")
    summed = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("way")
    return summed.select("lang", ways, "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")

"""Katz backoff scores of whole documents under a bigram model of the corpus.

Tokens are lower-cased words and one end per document; a document's first token
has the begin as its history. With c the training counts and d the Good-Turing
discounts of each order,

    P(w | h) = d(c(h, w)) c(h, w) / c(h)   if c(h, w) > 0
             = a(h) P(w)                   otherwise; a(h) = 1 if c(h) = 0
    P(w)     = d(c(w)) c(w) / N,           P(unknown) = what is left
    a(h)     = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w) over seen w)

so every history's probabilities sum to one exactly (over the words and one
unknown). Counts up to K are discounted by Good-Turing with Katz's
renormalisation; larger ones by KEEP_BACK of a count, so that no history is left
without mass for the unseen; where the counts of counts are too sparse for
Good-Turing (zeros, or discounts outside (0, 1)), by an absolute discount.

The corpus has too many n-grams to broadcast, and a row per occurrence costs
more to move than to compute; so the occurrences travel as packed columns, one
blob for each block of documents and table partition, and all tables are
partitioned by hash:

1. by word: every occurrence (h, w, document) goes to the partition of w, which
   holds the complete counts c(w) and c(h, w). A first reading gives the counts
   of counts; a second one each document's sums of all that depends on w: seen
   bigrams, P(w) of unseen ones, and c(w) once more as the count of the history
   of what follows; a third one what goes to the next table. The shuffle that deals the
   occurrences is written once and read three times;
2. by history: the partition of h gets the sums over h's seen words, hence the
   backoff weight a(h), and the unseen occurrences of h, and gives the sums of
   log a(h);
3. by block of documents: the sums meet.

Words that make up more of a sample than half the mean partition by word (HOT_SHARE at
most) are split by their history, and pairs that do by block; their totals come with the
counts of counts. The sample is drawn from all of the table and grows with the partitions;
it decides the layout only.

Words and pairs are told apart by 64-bit hashes.

Edge cases: null and empty texts have the end alone; rows without an id count as
training rows and are scored; repeated rows count each; without training rows
every token is unknown (probability 1, score 0); an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ssjoin import mix

K, KEEP_BACK = 5, 0.05
BLOCK_TOKENS, HOT_SHARE = 1 << 21, 0.005
UNIT = 1e8
U = np.uint64
END, BEGIN = (U(xxhash.xxh3_64_intdigest(x)) for x in (b"", b" "))  # no word is empty or holds a space
#: Kinds of rows.
OCCURRENCES, ABOUT, SUMS, SEEN, UNSEEN = range(5)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers, each by byte planes, compressed."""
    out = []
    for c in columns:
        c = np.ascontiguousarray(c)
        planes = c.view(np.uint8).reshape(-1, c.dtype.itemsize).T.tobytes() if c.size else b""
        body = zstandard.ZstdCompressor(level=1).compress(planes)
        out.append(c.dtype.str.encode().ljust(4) + len(c).to_bytes(8, "little") + len(body).to_bytes(8, "little") + body)
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        kind, n, size = np.dtype(blob[at : at + 4].decode().strip()), int.from_bytes(blob[at + 4 : at + 12], "little"), int.from_bytes(blob[at + 12 : at + 20], "little")
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[at + 20 : at + 20 + size], max_output_size=max(1, n * kind.itemsize)), np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).reshape(n) if n else np.empty(0, kind))
        at += 20 + size
    return out


def small(x: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest unsigned type."""
    return x.astype(np.min_scalar_type(int(x.max())) if x.size else np.uint8)


def fixed(x: np.ndarray) -> np.ndarray:
    """Sums in units of 1 / UNIT: they pack well, and add up the same in any order."""
    return np.rint(x * UNIT).astype(np.int64)


def deltas(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def pair(w: np.ndarray, h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(w * U(0x9E3779B97F4A7C15) + h)


def placed(key: np.ndarray, n: int) -> np.ndarray:
    """Table partition of scattered keys."""
    return ((key >> U(32)) * U(n) >> U(32)).astype(np.int32)


def member(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each x in the sorted array, or -1."""
    if not sorted_.size:
        return np.full(x.size, -1)
    at = np.minimum(np.searchsorted(sorted_, x), sorted_.size - 1)
    return np.where(sorted_[at] == x, at, -1)


def hashes(text: bytes | None) -> np.ndarray:
    w = (text or b"").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, w), U, len(w))


@dataclass(frozen=True)
class Layout:
    parts: int
    words: np.ndarray  # hot words and pairs, sorted
    pairs: np.ndarray
    slots: np.ndarray  # the number of each partition

    def by_word(self, w: np.ndarray, p: np.ndarray, block: int) -> np.ndarray:
        key = mix(w)
        hot = member(self.words, w) >= 0
        key[hot] = mix(p[hot])
        hot = member(self.pairs, p) >= 0
        with np.errstate(over="ignore"):
            key[hot] = mix(p[hot] + U(block))
        return placed(key, self.parts)


def emit(docs: DataFrame, layout: Layout) -> DataFrame:
    """(part, block, kind, blob) of the documents (doc_id, held_out, text)."""

    def block_rows(block: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        n = np.array([len(r[2]) + 1 for r in rows])
        w = np.concatenate([x for r in rows for x in (r[2], [END])]).astype(U)
        h = np.empty_like(w)
        h[1:] = w[:-1]
        h[np.cumsum(n) - n] = BEGIN
        doc = np.repeat(np.arange(len(rows)), n)
        held = np.array([r[1] for r in rows], bool)
        part = layout.by_word(w, pair(w, h), block)
        order = np.argsort(w, kind="stable")
        order = order[np.argsort(part[order], kind="stable")]
        w, h, doc, part = w[order], h[order], doc[order], part[order]
        edges = np.searchsorted(part, np.arange(layout.parts + 1))
        keys, blobs = [], []
        for k in np.flatnonzero(np.diff(edges)):
            s = slice(edges[k], edges[k + 1])
            first = np.flatnonzero(np.diff(w[s], prepend=~w[s][:1]))
            kinds, at = np.unique(h[s], return_inverse=True)
            # documents ascend within a word
            d = doc[s].astype(np.int32)
            step = np.diff(d, prepend=np.int32(0))
            step[first] = d[first]
            keys.append(int(layout.slots[k]))
            blobs.append(pack(deltas(w[s][first]), small(np.diff(np.append(first, d.size))), deltas(kinds), small(at), small(step), np.packbits(held)))
        about = pack(np.array([r[0] if r[0] is not None else 0 for r in rows], np.int64), np.array([r[0] is None for r in rows]), n.astype(np.int64), held)
        size = len(keys) + 1
        yield pa.RecordBatch.from_pydict({"part": pa.array([*keys, int(layout.slots[block % layout.parts])], pa.int32()), "block": pa.array([block] * size, pa.int64()), "kind": pa.array([OCCURRENCES] * len(keys) + [ABOUT], pa.int32()), "blob": pa.array([*blobs, about], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, tokens = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            for i, held, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), strict=True):
                x = hashes(text)
                rows.append((i, bool(held), x))
                tokens += len(x) + 1
                if tokens >= BLOCK_TOKENS:
                    yield from block_rows(block, rows)
                    block, rows, tokens = block + 1, [], 0
        if rows:
            yield from block_rows(block, rows)

    return docs.mapInArrow(run, "part int, block long, kind int, blob binary")


class Words:
    """One partition of the table by word: all its occurrences, and their training counts."""

    def __init__(self, rows: list[tuple[int, bytes]], layout: Layout):
        w, h, doc, train = [], [], [], []
        self.blocks, self.sizes = [], []
        for block, blob in rows:
            dw, runs, dh, at, step, held = unpack(blob)
            with np.errstate(over="ignore"):
                dw, dh = np.cumsum(dw, dtype=U), np.cumsum(dh, dtype=U)
            runs = runs.astype(np.int64)
            first = np.cumsum(runs) - runs
            total = np.cumsum(step, dtype=np.int64)
            d = total - np.repeat(total[first] - step[first], runs)
            w.append(np.repeat(dw, runs))
            h.append(dh[at])
            doc.append(d.astype(np.int32))
            train.append(np.unpackbits(held)[d] == 0)
            self.blocks.append(block)
            self.sizes.append(d.size)
        self.w, self.h, self.doc, self.train = (np.concatenate(x) for x in (w, h, doc, train))
        self.p = pair(self.w, self.h)
        self.words, self.word_at, self.c_word = self._counts(self.w)
        self.pairs, self.pair_at, self.c_pair = self._counts(self.p)
        self.hot_words, self.hot_pairs = member(layout.words, self.words), member(layout.pairs, self.pairs)

    def _counts(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(key)
        s = key[order]
        new = np.empty(s.size, bool)
        new[:1] = True
        np.not_equal(s[1:], s[:-1], out=new[1:])
        at = np.empty(s.size, np.int32)
        at[order] = np.cumsum(new) - 1
        kinds = s[new]
        return kinds, at, np.bincount(at, weights=self.train, minlength=kinds.size).astype(np.int64)


def tally(c: np.ndarray) -> np.ndarray:
    """Of counts: how many are 1 to K + 1; how many there are; their sum."""
    c = c[c > 0]
    return np.array([*np.bincount(np.minimum(c, K + 2), minlength=K + 3)[1 : K + 2], c.size, c.sum()], np.int64)


SPAN = K + 3


def grouped(batches: Iterator[pa.RecordBatch], of: int, make: Callable[[int, list[tuple]], Iterator[pa.RecordBatch]], through: tuple[int, ...] = (), without: tuple[int, ...] = ()) -> Iterator[pa.RecordBatch]:
    """The rows sorted by column ``of``, one value at a time; rows of the kinds ``through`` pass as they are."""
    at, rows = None, []
    for b in batches:
        for row in b.to_pylist():
            if row["kind"] in through:
                yield one(row)
            if row["kind"] in through + without:
                continue
            key = row[b.schema.names[of]]
            if rows and key != at:
                yield from make(at, rows)
                rows = []
            at = key
            rows.append(row)
    if rows:
        yield from make(at, rows)


OUT = "part int, block long, kind int, blob binary"


def one(row: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": pa.array([row["part"]], pa.int32()), "block": pa.array([row["block"]], pa.int64()), "kind": pa.array([row["kind"]], pa.int32()), "blob": pa.array([row["blob"]], pa.binary())})


def statistics(occ: DataFrame, layout: Layout) -> DataFrame:
    """One row: the tallies of words and pairs, and the totals of hot words and pairs, as an array of longs."""
    n = 2 * SPAN + layout.words.size + layout.pairs.size

    def make(_: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        t = Words([(r["block"], r["blob"]) for r in rows], layout)
        out = [tally(t.c_word[t.hot_words < 0]), tally(t.c_pair[t.hot_pairs < 0])]
        for hot, c, size in ((t.hot_words, t.c_word, layout.words.size), (t.hot_pairs, t.c_pair, layout.pairs.size)):
            out.append(np.bincount(hot[hot >= 0], weights=c[hot >= 0], minlength=size).astype(np.int64)[:size])
        yield pa.RecordBatch.from_pydict({"k": pa.array(range(n), pa.int32()), "v": pa.array(np.concatenate(out), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from grouped(batches, 0, make, without=(ABOUT,))

    sums = occ.sortWithinPartitions("part", "block").mapInArrow(run, "k int, v long").groupBy("k").agg(F.sum("v").alias("v"))
    return sums.agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("stats"))


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounted count of the counts 0 to K, from the tally."""
    r = np.arange(1, K + 1)
    n_r, n_next, n1, tail = n[:K].astype(float), n[1 : K + 1].astype(float), float(n[0]), float(n[K])
    d = None
    if (n_r > 0).all() and tail > 0:
        a = (K + 1) * tail / n1
        if a < 1:
            d = ((r + 1) * n_next / n_r / r - a) / (1 - a)
    if d is None or (d <= 0).any() or (d >= 1).any():
        back = n1 / (n1 + 2 * float(n[1])) if n1 else 0.5
        d = 1 - min(max(back, 0.1), 0.9) / r
    return np.array([0.0, *(d * r)])


class Model:
    """The global figures of the model."""

    def __init__(self, stats: np.ndarray, layout: Layout):
        words, pairs, rest = stats[:SPAN], stats[SPAN : 2 * SPAN], stats[2 * SPAN :]
        self.hot_words, self.hot_pairs = rest[: layout.words.size], rest[layout.words.size :]
        words, pairs = words + tally(self.hot_words), pairs + tally(self.hot_pairs)
        self.n, self.v = int(words[-1]), int(words[-2])
        self.d1, self.d2 = discounts(words), discounts(pairs)
        low = words[:K].astype(float)
        mass = low @ self.d1[1:] + (self.n - low @ np.arange(1, K + 1)) - KEEP_BACK * (self.v - low.sum())
        self.unknown = 1 - mass / self.n if self.n else 1.0

    @staticmethod
    def kept(c: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return np.where(c > K, c - KEEP_BACK, d[np.minimum(c, K)])

    def p_word(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.kept(c, self.d1) / max(1, self.n), self.unknown)


def log10(x: np.ndarray) -> np.ndarray:
    return np.log10(np.where(x > 0, x, 1.0))


def by_word(occ: DataFrame, stats: DataFrame, layout: Layout, sums: bool) -> DataFrame:
    """Rows of the kinds ABOUT and SUMS (per block) or, if not ``sums``, SEEN and UNSEEN (per partition by history).

    The two are read off separately, so that each moves once, to where it is needed.
    """
    # the totals grow with the partitions, so they go to the first row of each only
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    both = occ.sortWithinPartitions("part", "block").withColumn("stats", F.when(first, stats.scalar()))
    parts = layout.parts

    def by_home(h: np.ndarray, kind: int, columns: Callable[[np.ndarray], tuple], sort: bool) -> Iterator[pa.RecordBatch]:
        """A row for each partition by history; its columns by their places."""
        home = placed(mix(h), parts)
        order = np.argsort(home, kind="stable")
        edges = np.searchsorted(home[order], np.arange(parts + 1))
        for k in np.flatnonzero(np.diff(edges)):
            s = order[edges[k] : edges[k + 1]]
            s = s[np.argsort(h[s], kind="stable")] if sort else s
            yield one({"part": int(layout.slots[k]), "block": -1, "kind": kind, "blob": pack(deltas(h[s]), *columns(s))})

    def make(m: Model, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        t = Words([(r["block"], r["blob"]) for r in rows], layout)
        rows.clear()
        own = t.c_pair.copy()
        hot = t.hot_words >= 0
        t.c_word[hot] = m.hot_words[t.hot_words[hot]]
        hot = t.hot_pairs >= 0
        t.c_pair[hot] = m.hot_pairs[t.hot_pairs[hot]]
        seen = t.c_pair > 0
        ends = np.cumsum([0, *t.sizes])
        if sums:
            base = np.log10((t.c_word + 0.1) / (m.n + 0.1 * (m.v + 1)))
            word, history = np.log10(m.p_word(t.c_word)), log10(t.c_word.astype(float))
            bigram, known = log10(m.kept(t.c_pair, m.d2)), (t.c_word > 0).astype(float)
            for block, at, end in zip(t.blocks, ends[:-1], ends[1:], strict=True):
                d, w, p = t.doc[at:end], t.word_at[at:end], t.pair_at[at:end]
                score = np.where(seen[p], bigram[p], word[w]) - history[w]
                found = [np.bincount(d, weights=x) for x in (base[w], score, known[w])]
                yield one({"part": int(layout.slots[block % parts]), "block": block, "kind": SUMS, "blob": pack(fixed(found[0]), fixed(found[1]), found[2].astype(np.int64), np.array([m.n]))})
            return
        # what the seen pairs add to their history: discounted count, probability of the word, count; a pair in several partitions adds its share
        first = np.empty(t.pairs.size, np.int64)
        first[t.pair_at] = np.arange(t.pair_at.size)
        here = np.flatnonzero(own > 0)
        share = own[here] / t.c_pair[here]
        kinds, to = np.unique(t.h[first[here]], return_inverse=True)
        p = m.p_word(t.c_word[t.word_at[first[here]]])
        columns = [np.bincount(to, weights=x, minlength=kinds.size) for x in (m.kept(t.c_pair[here], m.d2) * share, p * share, own[here])]
        yield from by_home(kinds, SEEN, lambda s: tuple(x[s] for x in columns), False)
        gone = np.flatnonzero(~seen[t.pair_at])
        block = np.repeat(np.array(t.blocks, np.int64), t.sizes)[gone]
        doc = t.doc[gone]
        yield from by_home(t.h[gone], UNSEEN, lambda s: (block[s], doc[s]), True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = (b for b in batches if b.num_rows)
        for b in filled:
            m = Model(np.array(b.column(b.schema.get_field_index("stats"))[0].as_py(), np.int64), layout)
            yield from grouped(chain([b], filled), 0, lambda _, rows: make(m, rows), **{"through" if sums else "without": (ABOUT,)})

    return both.mapInArrow(run, OUT)


def by_history(rows: DataFrame, layout: Layout) -> DataFrame:
    """Turns SEEN and UNSEEN into SUMS of what the backoff weights add to each document."""

    def make(part: int, rows_: list[dict]) -> Iterator[pa.RecordBatch]:
        seen = [unpack(r["blob"]) for r in rows_ if r["kind"] == SEEN]
        gone = [unpack(r["blob"]) for r in rows_ if r["kind"] == UNSEEN]
        if not seen or not gone:
            return
        with np.errstate(over="ignore"):
            keys = np.concatenate([np.cumsum(x[0], dtype=U) for x in seen])
            h = np.concatenate([np.cumsum(x[0], dtype=U) for x in gone])
        kinds, to = np.unique(keys, return_inverse=True)
        kept, p, c = (np.bincount(to, weights=np.concatenate([x[k] for x in seen]), minlength=kinds.size) for k in (1, 2, 3))
        adds = log10(c) + np.log10((1 - kept / c) / (1 - p))
        block, doc = (np.concatenate([x[k] for x in gone]) for k in (1, 2))
        at = member(kinds, h)
        block, doc, x = block[at >= 0], doc[at >= 0], adds[at[at >= 0]]
        order = np.argsort(block, kind="stable")
        block, doc, x = block[order], doc[order], x[order]
        for b in np.unique(block):
            s = slice(*np.searchsorted(block, [b, b + 1]))
            sums = fixed(np.bincount(doc[s], weights=x[s]))
            none = np.zeros(sums.size, np.int64)
            yield one({"part": part, "block": int(b), "kind": SUMS, "blob": pack(none, sums, none, none[:1])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from grouped(batches, 0, make)

    return rows.mapInArrow(run, OUT)


def by_block(rows: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def make(_: int, rows_: list[dict]) -> Iterator[pa.RecordBatch]:
        about = next(unpack(r["blob"]) for r in rows_ if r["kind"] == ABOUT)
        ids, null, n, held = about
        total, trained = np.zeros((3, ids.size), np.int64), 0
        for r in rows_:
            if r["kind"] == SUMS:
                *sums, tokens = unpack(r["blob"])
                trained = max(trained, int(tokens[0]))
                for t, x in zip(total, sums, strict=True):
                    t[: x.size] += x
        yield pa.RecordBatch.from_arrays([pa.array(ids, mask=null.astype(bool)), pa.array(held.astype(bool)), pa.array(n), pa.array(total[2]), pa.array([trained] * ids.size, pa.int64()), pa.array(total[0] / UNIT), pa.array(total[1] / UNIT)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from grouped(batches, 1, make)

    return rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def hot(docs: DataFrame, parts: int, sample: int = 2_000) -> Layout:
    """The layout, with the words and pairs that are frequent in a sample of about ``sample`` rows, or two a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [hashes(t) for t in b.column(0).cast(pa.binary()).to_pylist()]
            w = np.concatenate([y for z in x for y in (z, [END])]).astype(U)
            h = np.concatenate([y for z in x for y in ([BEGIN], z)]).astype(U)
            for pairs, key in ((False, w), (True, pair(w, h))):
                kinds, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_pydict({"pairs": pa.array([pairs] * kinds.size), "key": pa.array(kinds.view(np.int64)), "n": pa.array(n, pa.int64())})

    # rows of every partition, so that no order of the table hides a word
    fraction = min(0.05, max(sample, 2 * parts) / max(1, docs.count()))
    counts = docs.select("text").sample(fraction, 11).mapInArrow(run, "pairs boolean, key long, n long").groupBy("pairs", "key").agg(F.sum("n").alias("n")).persist()
    total = counts.filter("pairs").agg(F.sum("n")).first()[0] or 0
    # the share bounds both lists; a pair's word is at least as frequent as the pair, and so always listed with it
    often = counts.filter(F.col("n") >= min(HOT_SHARE, 0.5 / parts) * total).select("pairs", "key").collect()
    found = [[r for r in often if r["pairs"] == k] for k in (False, True)]
    counts.unpersist()
    # a number for each partition that hash partitioning deals to a partition of its own
    slot = docs.sparkSession.range(16 * parts).select(F.col("id").cast("int").alias("id"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("p"))
    slots = sorted(r["id"] for r in slot.groupBy("p").agg(F.min("id").alias("id")).collect())
    slots = np.array([*slots, *(x for x in range(16 * parts) if x not in set(slots))][:parts], np.int64)
    return Layout(parts, *(np.sort(np.array([r["key"] for r in x], np.int64).view(U)) for x in found), slots)


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row; rows for which ``held_out`` is true are not learned from.

    There are as many table partitions as shuffle partitions; a partition is
    held in memory, so size them to the data as for any shuffle. By word, no key
    that is not split exceeds about half a mean partition; by history, all
    unseen held-out occurrences after one word are in one partition.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    layout = hot(docs, parts)
    occ = emit(docs, layout).repartition(parts, "part")
    stats = statistics(occ, layout)
    unseen = by_word(occ, stats, layout, False).repartition(parts, "part").sortWithinPartitions("part")
    sums = by_word(occ, stats, layout, True).unionByName(by_history(unseen, layout))
    return by_block(sums.repartition(parts, "block").sortWithinPartitions("block"))

"""N-gram Jaccard join: size-aware, heavy-light, exact.

A document's set is that of its distinct shingles of ``k`` words (64-bit
hashes; equality of shingles and of sets is equality of 64-bit hashes). Equal
sets are one class; the join runs between classes. Two sets link if
``den * |A & B| >= num * |A | B|``, in integers, on the sets themselves.

Candidates share a *signature*:

* small sets (up to a boundary ``x``) enumerate their subsets of fixed size.
  Sets of a and b shingles can link only if they share
  ``o(a, b) = ceil(num * (a + b) / (num + den))`` of them, so both list their
  subsets of that size, and linked sets have one in common;
* large sets are found by inverted lists. The space of hashes is cut into m
  equal parts, where m exceeds the greatest number of differences that linked
  sets of their sizes can have; so at least one part of two linked sets is the
  same, and the lists are keyed by (size class, part, content of the part).
  A list of such whole parts is short even for shingles that are in very many
  documents, such as those of a common passage, where one by shingle is not.
  Empty parts would make long lists: m exceeds the differences by a slack, and
  only a set with more empty parts than the slack lists those, too. So two
  linked sets agree in a part that is not empty in one of them, or both list
  their empty parts.

The boundary is chosen by cost: for each size up to ``LIGHT`` the number of
subsets against that of parts (each weighted by ``LIST_COST`` for the
verification that lists call for), over the sizes that the corpus has.

A list is never expanded into all its pairs. Lists with the same members count
once. In each list, the member that shares most lists is the *hub*, all others
are compared with it, and the links found merge the components. After
``HUBS`` such rounds, the lists that still hold members of several components
are read in blocks of ``BLOCK`` members: of the pairs between components, those pass whose
*outlines* differ in no more places than linked sets can. An outline holds a byte for each
of about as many parts of the space of hashes as the set has shingles, the sum of the hashes in
that part; each place that differs costs a difference at least, so no linked pair is
lost. What passes is compared on the sets themselves. No link between two components goes
unseen, so the components are exact.

Edge cases: a null or empty text, or one of white space only, has no set, links
with nothing and is its own component; fewer than ``k`` words are one shingle;
repeated rows and equal sets share a component; rows without an id get a result
row, and the least non-null id of their component (null if there is none);
empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations
from math import ceil, comb, exp, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, settle
from .components import components

LIGHT, LIST_COST, HUBS, BLOCK = 24, 2.0, 2, 512
GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of k words; A-Z count as a-z."""
    w = (text or b"").lower().split()
    n = len(w)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, n)
    size = min(n, k)
    acc = np.full(n - size + 1, size, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            acc += h[j : n - size + 1 + j] * np.uint64(pow(GOLDEN, j + 1, 1 << 64))
        acc = mix(acc)
    acc.sort()
    return acc[np.concatenate([[True], acc[1:] != acc[:-1]])]


def key_of(u: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(u.tobytes()) - (1 << 63)


@dataclass(frozen=True)
class Jaccard:
    k: int = 4
    num: int = 85
    den: int = 100
    light: int = 0  # the boundary: sets up to this size enumerate subsets

    def overlap(self, a: int, b: int) -> int:
        return -(-self.num * (a + b) // (self.num + self.den))

    def partners(self, n: int) -> range:
        """Sizes that can link with n."""
        return range(-(-n * self.num // self.den), n * self.den // self.num + 1)

    def linked(self, u: np.ndarray, v: np.ndarray) -> bool:
        both = np.intersect1d(u, v, assume_unique=True).size
        return self.den * both >= self.num * (u.size + v.size - both)

    @cached_property
    def classes(self) -> list[tuple[int, int, int, int]]:
        """Of each size class: least and greatest size, parts, slack for empty parts."""
        out, low = [], 1
        while low < 1 << 40:
            high = low * self.den // self.num
            most = high + high * self.den // self.num
            differences = (self.den - self.num) * most // (self.den + self.num)
            empty = (differences + 1) * exp(-low / (differences + 1))
            slack = min(ceil(empty + 4 * sqrt(empty)) + 1, max(2, differences // 2))
            out.append((low, high, differences + 1 + slack, slack))
            low = high + 1
        return out

    def joins(self, n: int) -> list[int]:
        """Classes in which a set of size n takes part: its own, and the lesser one if a partner can be there."""
        at = next(i for i, c in enumerate(self.classes) if n <= c[1])
        return [at] + ([at - 1] if at and self.classes[at - 1][1] >= self.partners(n)[0] else [])

    def subset_sizes(self, n: int, most: int) -> set[int]:
        return {o for b in self.partners(n) if b <= most and (o := self.overlap(n, b)) <= min(n, b) and not (o == n == b)}

    def signatures(self, u: np.ndarray) -> np.ndarray:
        n, out = u.size, []
        if not n:
            return u
        with np.errstate(over="ignore"):
            x = mix(u + np.uint64(0x632BE59BD9B4E019))
            if n <= self.light:
                for o in sorted(self.subset_sizes(n, self.light)):
                    total = x.sum(dtype=np.uint64)
                    gone = np.array([x[list(c)].sum(dtype=np.uint64) for c in combinations(range(n), n - o)], np.uint64)
                    out.append(mix((total - gone) ^ np.uint64(o << 48 | 1)))
            if self.partners(n)[-1] > self.light:
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
                for c in self.joins(n):
                    _, _, m, slack = self.classes[c]
                    edges = np.searchsorted(u, _edges(m))
                    size = np.diff(edges)
                    sig = mix(mix(sums[edges[1:]] - sums[edges[:-1]] + np.arange(m, dtype=np.uint64)) + np.uint64(c << 8 | 2))
                    empty = size == 0
                    out.append(sig if empty.sum() > slack else sig[~empty])
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def outline(u: np.ndarray) -> np.ndarray:
    """A byte for each of 2 ** ceil(log2(n)) equal parts of the space of hashes: the sum of the (mixed) hashes in it."""
    bits = max(1, int(u.size - 1).bit_length())
    out = np.bincount((u >> np.uint64(64 - bits)).astype(np.int64), weights=(mix(u + np.uint64(0x1B873593)) >> np.uint64(56)).astype(float), minlength=1 << bits)
    return out.astype(np.int64).astype(np.uint8)


def folded(x: np.ndarray, size: int) -> np.ndarray:
    """The outline in fewer parts: sums of neighbours are the sums of the joint parts."""
    return x if x.size == size else x.reshape(size, -1).sum(1, dtype=np.uint8)


_EDGES: dict[int, np.ndarray] = {}


def _edges(m: int) -> np.ndarray:
    """Where the m parts of the space of hashes begin, and its end."""
    if m not in _EDGES:
        if len(_EDGES) > 512:
            _EDGES.clear()
        _EDGES[m] = np.array([(i << 64) // m for i in range(m)] + [(1 << 64) - 1], np.uint64)
    return _EDGES[m]


def boundary(j: Jaccard, sizes: dict[int, int]) -> int:
    """The size up to which subsets cost less than lists, over the given numbers of sets by size."""
    best, at, saved = 0.0, 0, 0.0
    for n in range(1, LIGHT + 1):
        light = sum(comb(n, o) for o in j.subset_sizes(n, n * j.den // j.num))
        lists = LIST_COST * sum(j.classes[c][2] for c in j.joins(n))
        saved += sizes.get(n, 0) * (lists - light)
        if saved > best:
            best, at = saved, n
    return at


def _bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def sets(docs: DataFrame, j: Jaccard) -> DataFrame:
    """(doc_id, n, key, text_hash) of every row of (doc_id, text, text_hash); the key is null where there is no set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t, j.k) for t in _bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([u.size for u in found], pa.int64()), pa.array([key_of(u) if u.size else None for u in found], pa.int64()), b.column(2)], ["doc_id", "n", "key", "text_hash"])

    return docs.mapInArrow(run, "doc_id long, n long, key long, text_hash long")


def postings(docs: DataFrame, j: Jaccard) -> DataFrame:
    """(sig, key) of every set; a task lists a set once however many copies it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            sigs, keys, total = [], [], 0
            for t in _bytes(b.column(0)):
                u = shingles(t, j.k)
                if u.size and (key := key_of(u)) not in seen:
                    seen.add(key)
                    s = j.signatures(u)
                    sigs.append(s.view(np.int64))
                    keys.append(np.full(s.size, key, np.int64))
                    total += s.size
                if total > 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (sigs, keys)], ["sig", "key"])
                    sigs, keys, total = [], [], 0
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (sigs, keys)], ["sig", "key"])

    return docs.mapInArrow(run, "sig long, key long")


def lists(posts: DataFrame) -> DataFrame:
    """(list, key): the distinct inverted lists that hold two sets or more.

    A list is named by a hash of its members, so those of the same members meet.
    """
    w = W.partitionBy("sig")
    part = lambda salt: F.sum(F.shiftrightunsigned(F.xxhash64("key", F.lit(salt)), 24)).over(w)
    rows = posts.withColumn("low", F.min("key").over(w)).withColumn("high", F.max("key").over(w)).withColumn("s1", part(1)).withColumn("s2", part(2))
    return rows.filter("low < high").select(F.xxhash64("low", "high", "s1", "s2").alias("list"), "key").distinct()


def named(docs: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text) of one document for each of the keys, and of its copies under the same id.

    A row is named by id and hash of its text, as ids may be null or repeat.
    """
    one = classes.join(keys, "key").groupBy("key").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
    one = one.select("key", F.col("one.doc_id").alias("i"), F.col("one.text_hash").alias("t"))
    return docs.join(one, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("t"))).select("key", "text")


def texts_of(docs: DataFrame, classes: DataFrame, keys: DataFrame, j: Jaccard) -> DataFrame:
    """(key, text, outline) of one document for each of the keys. docs: doc_id, text, text_hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two texts may have one hash: only the one of the key's set passes."""
        for b in batches:
            found = [shingles(t, j.k) for t in _bytes(b.column(1))]
            keep = [u.size > 0 and key_of(u) == k for k, u in zip(b.column(0).to_pylist(), found, strict=True)]
            outlines = pa.array([outline(u).tobytes() if ok else None for u, ok in zip(found, keep, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), outlines], ["key", "text", "outline"]).filter(pa.array(keep))

    return named(docs, classes, keys).mapInArrow(run, "key long, text string, outline binary").dropDuplicates(["key"])


def across(rows: DataFrame, outlines: DataFrame, j: Jaccard) -> DataFrame:
    """Pairs (a, b) of one list and of different roots that their outlines let pass. rows: list, key, root, n."""
    sizes = rows.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = rows.join(sizes, "list").join(outlines, "key").withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("list", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "key", "root", "n", "outline")
    names = ["list", "i", "j", "mine", "key", "root", "n", "outline"]

    def pairs(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        i, k = group[0][1], group[0][2]
        place, key, root, n = (np.array([g[c] for g in group]) for c in (3, 4, 5, 6))
        x = [np.frombuffer(g[7], np.uint8) for g in group]
        size = min(map(len, x))
        x = np.array([folded(y, size) for y in x])
        rest = np.flatnonzero(place == k)
        a, b = [], []
        for r in np.flatnonzero(place == i):
            c = rest[(root[rest] != root[r]) & (j.den * np.minimum(n[rest], n[r]) >= j.num * np.maximum(n[rest], n[r]))]
            if i == k:
                c = c[c > r]
            if c.size:
                c = c[np.count_nonzero(x[c] != x[r], axis=1) <= (j.den - j.num) * (n[c] + n[r]) // (j.den + j.num)]
                a += [key[r]] * c.size
                b += key[c].tolist()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                if group and row[:3] != group[0][:3]:
                    yield from pairs(group)
                    group = []
                group.append(row)
        if group:
            yield from pairs(group)

    return dealt.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, j: Jaccard) -> DataFrame:
    """The pairs (a, b) that link. Each pair's texts meet in one row; the sets are made anew from them."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, v = None, None
        for b in batches:
            ids, ta, tb, keep = b.column(1).to_pylist(), _bytes(b.column(2)), _bytes(b.column(3)), []
            for i, x, y in zip(ids, ta, tb, strict=True):
                if i != last:
                    last, v = i, shingles(y, j.k)
                keep.append(j.linked(shingles(x, j.k), v))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep))

    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return rows.mapInArrow(run, "a long, b long")


def _fits(a: Column, b: Column, j: Jaccard) -> Column:
    return j.den * F.least(a, b) >= j.num * F.greatest(a, b)


def links(docs: DataFrame, classes: DataFrame, j: Jaccard) -> DataFrame:
    """Links (a, b) between keys that make up the components of all links."""
    posts = postings(docs.select("text"), j)
    members = settle(lists(posts), "join-lists")
    sizes = classes.filter("key is not null").groupBy("key").agg(F.max("n").alias("n"))
    weight = members.groupBy("list").agg(F.count("*").alias("c")).join(members, "list").groupBy("key").agg(F.sum("c").alias("w")).join(sizes, "key")
    members = settle(members.join(weight, "key"), "join-members")
    texts = settle(texts_of(docs, classes, members.select("key").distinct(), j), "join-texts")
    found, done, rows = None, None, members.withColumn("root", F.col("key"))
    for turn in range(HUBS + 1):
        if turn < HUBS:
            hubs = rows.groupBy("list").agg(F.max(F.struct("w", "key", "n", "root")).alias("h"))
            both = rows.join(hubs, "list").filter((F.col("root") != F.col("h.root")) & _fits(F.col("n"), F.col("h.n"), j))
            pairs = both.select(F.col("key").alias("a"), F.col("h.key").alias("b"))
        else:
            pairs = across(rows.select("list", "key", "root", "n"), texts.select("key", "outline"), j)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = settle(pairs.join(done, ["a", "b"], "left_anti") if done is not None else pairs, "join-pairs")
        new = settle(verified(pairs, texts, j), "join-links")
        found = new if found is None else found.unionByName(new)
        if turn == HUBS:
            break
        done = pairs if done is None else done.unionByName(pairs)
        roots = components(found, "a", "b")
        rows = members.join(roots, members["key"] == roots["node"], "left").select("list", "key", "w", "n", F.coalesce("root", "key").alias("root"))
        mixed = rows.groupBy("list").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most").select("list")
        rows = settle(rows.join(mixed, "list", "left_semi"), "join-open")
        # a list's next hub is of another component than its last one if it can be
        if turn + 1 < HUBS:
            used = rows.join(pairs.select(F.col("b").alias("key")).unionByName(pairs.select(F.col("a").alias("key"))).distinct().withColumn("met", F.lit(1)), "key", "left")
            rows = used.withColumn("w", F.when(F.col("met") == 1, F.lit(0)).otherwise(F.col("w"))).drop("met")
        if rows.isEmpty():
            break
    return found


def grouped(docs: DataFrame, j: Jaccard) -> DataFrame:
    """(doc_id, n, key, text_hash, class_id, component_id, root) of every row of (doc_id, text); root names the component, null without a set."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    classes = settle(sets(docs, j), "join-sets")
    small = {x["n"]: x["c"] for x in classes.filter(F.col("n").between(1, LIGHT)).groupBy("n").agg(F.countDistinct("key").alias("c")).collect()}
    j = Jaccard(j.k, j.num, j.den, boundary(j, small))
    roots = components(links(docs, classes, j), "a", "b")
    by_key = classes.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("class_id"))
    rooted = by_key.join(roots, by_key["key"] == roots["node"], "left").select("key", "class_id", F.coalesce("root", "key").alias("root"))
    least = rooted.groupBy("root").agg(F.min("class_id").alias("component_id"))
    return classes.join(rooted.join(least, "root"), "key", "left").select("doc_id", "n", "key", "text_hash", "class_id", "component_id", "root")


def join(docs: DataFrame, j: Jaccard = Jaccard(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class_id: least id of the rows with the same set, component_id), a row per row of ``docs``."""
    rows = grouped(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), j)
    own = F.col("key").isNull()
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def representatives(docs: DataFrame, j: Jaccard, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, less those that are linked, directly or not, with one that stays.

    Of each component, the row with the least id stays (rows without an id come
    last; of several with that id, that of the least hash of its text); rows without words all stay.
    """
    rows = settle(grouped(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), j), "join-groups")
    rank = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), F.col("text_hash").alias("t"))
    first = rows.filter("root is not null").groupBy("root").agg(F.min(rank).alias("first"))
    copies = rows.filter("root is not null").groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("c")).join(first, "root")
    is_first = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), F.col("text_hash").alias("t")) == F.col("first")
    copies = settle(copies.select("doc_id", "text_hash", "c", is_first.alias("stays")), "join-copies")
    # the rows as structs, so that no name of theirs clashes
    packed = docs.select(F.struct("*").alias("row"), docs[doc_id].cast("long").alias("i"), F.xxhash64(docs[text]).alias("t"))
    same = F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_hash"))
    gone = settle(copies.filter(~F.col("stays")).select("doc_id", "text_hash"), "join-gone")
    kept = packed.join(broadcast_if_small(gone), same, "left_anti")
    again = settle(copies.filter("stays and c > 1").select("doc_id", "text_hash"), "join-again")
    if not again.isEmpty():  # equal rows of one id: the first of them stays
        one = kept.join(broadcast_if_small(again), same, "left_semi").groupBy("i", "t").agg(F.first("row").alias("row"))
        kept = kept.join(broadcast_if_small(again), same, "left_anti").select("row").unionByName(one.select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

"""Approximate nearest neighbours by randomly rotated one-bit codes.

Index. Rows of one vector are one entry, with its least ids. Centroids are fitted per
dimension by k-means on a bounded sample (``sample`` entries); every entry goes
to the cell of its nearest centroid. Its residual, turned by a seeded random
rotation and scaled to length 1, is stored as one bit a component, with two
correction scalars: the residual's length, and the inner product of residual
and code (Gao and Long, "RaBitQ", 2024).

Search. A query reads the nearest cells until they hold ``scan`` entries, so
small sets are read whole, and at least as many cells as it takes on the sample to
reach ``recall`` of the neighbours there; data without clusters take most
cells, and then the query set is held against all rows, block by block. Its rotated residual makes a
table of 256 sums per byte of code, from which the packed bits give the
estimate of the inner product, and so of the distance. With the estimate's
error bound (``epsilon`` standard deviations) each entry gets a lower bound;
the entries with the least estimates are measured exactly, and then every
entry whose lower bound is not above the worst of the best so far.

Cells are cut into blocks of at most about ``block`` entries, and their queries
into chunks of about ``chunk``; each block meets each chunk in a task, so no
group grows with the data. A vector that a third of all rows share is one
entry; its ids are cut to the least ``top + 1`` by a limit that works before
the shuffle (no answer needs more of them), and its queries are one query.

Edge cases: rows whose id is null, or whose vector is null, empty, zero, or
holds null or non-finite components take no part; repeated rows count once; an
id with several vectors is a candidate by each, and a query by each, under one id;
vectors of other dimensions are no candidates; ties go to the smaller id;
fewer than ``top`` candidates give all of them; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settle


@dataclass(frozen=True)
class Search:
    top: int = 10
    sample: int = 16_384
    cell: int = 512  # entries a cell holds on average,
    most_cells: int = 1024
    recall: float = 0.98
    scan: int = 6_000
    epsilon: float = 3.0
    block: int = 8_192
    chunk: int = 1_024
    seed: int = 5


@functools.lru_cache(maxsize=8)
def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(1) - 2 * x @ centroids.T, axis=1)


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    rng = np.random.default_rng([seed, k])
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def probes_for(x: np.ndarray, centroids: np.ndarray, s: Search) -> int:
    """How many cells hold the share ``recall`` of the sampled neighbours of 256 sampled queries."""
    at, ranks = nearest(x, centroids), []
    for q in range(min(256, len(x))):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        near = np.argsort(d)[: min(s.top, len(x) - 1)]
        place = np.empty(len(centroids), int)
        place[np.argsort(((centroids - x[q]) ** 2).sum(1), kind="stable")] = np.arange(len(centroids))
        ranks.append(place[at[near]])
    ranks = np.concatenate(ranks) if ranks else np.zeros(1)
    return int(np.quantile(ranks, s.recall, method="higher")) + 1 if len(ranks) else 1


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def entries(rows: DataFrame, top: int) -> DataFrame:
    """(gid, vector, dim, ids: the least top + 1) of every distinct vector of (id, vector)."""
    one = rows.distinct()
    least = one.withColumn("r", F.row_number().over(W.partitionBy("vector").orderBy("id"))).filter(F.col("r") <= top + 1)
    return least.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.xxhash64("vector").alias("gid"), "vector", F.size("vector").alias("dim"), "ids")


def encode(x: np.ndarray, c: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, lengths, and inner products of unit residual and unit code, of vectors x in cells of centroids c (row by row)."""
    r = (x - c) @ turn.T
    length = np.linalg.norm(r, axis=1)
    bits = r >= 0
    inner = np.abs(r).sum(1) / np.sqrt(r.shape[1]) / np.where(length > 0, length, 1)
    return np.packbits(bits, axis=1), length, np.where(length > 0, inner, 1.0)


def estimate(codes: np.ndarray, length: np.ndarray, inner: np.ndarray, q: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated squared distances of the coded vectors from a query, whose rotated residual is q, and their lower bounds."""
    dim, m = q.size, codes.shape[1]
    padded = np.zeros(m * 8)
    padded[:dim] = q
    table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(float) @ padded.reshape(m, 8).T  # sums of the components whose bit is 1
    ones = table[codes, np.arange(m)].sum(1)
    dot = (2 * ones - q.sum()) / np.sqrt(dim) / inner
    far = np.sqrt(q @ q)
    error = epsilon * far * np.sqrt(np.maximum(0, 1 - inner**2)) / inner / np.sqrt(max(1, dim - 1))
    base = length**2 + far**2
    return base - 2 * length * dot, base - 2 * length * (dot + error)


def search(rows: DataFrame, is_query: Column, id_: str = "vec_id", vector: str = "embedding", s: Search = Search()) -> DataFrame:
    """(query_id, rank, id, score) for every usable row whose id (column ``id``) fulfils ``is_query``; see Search."""
    spark = rows.sparkSession
    rows = rows.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = settle(rows, "ann-rows")
    all_ = settle(entries(rows, s.top), "ann-entries")
    counts = {r["dim"]: r["n"] for r in all_.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    fitted = all_.orderBy(F.xxhash64("gid"), "gid").select("dim", "vector").limit(s.sample).toPandas()  # bounded by s.sample
    centroids: dict[int, np.ndarray] = {}
    probe: dict[int, int] = {}
    for dim, n in counts.items():
        x = np.array(fitted["vector"][fitted["dim"] == dim].tolist()).reshape(-1, dim)
        probe[dim] = 1
        centroids[dim] = kmeans(x, max(1, min(s.most_cells, n // s.cell, len(x) // 8)), s.seed) if len(x) else np.zeros((1, dim))
        if len(x):
            probe[dim] = probes_for(x, centroids[dim], s)
    first = dict(zip(sorted(centroids), np.cumsum([0, *[len(centroids[d]) for d in sorted(centroids)]]).tolist(), strict=False))
    shared = spark.sparkContext.broadcast((centroids, first))  # at most most_cells vectors per dimension

    def coded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cs, begin = shared.value
        for p in parts:
            for dim, g in p.groupby("dim"):
                x = np.array(g["vector"].tolist()).reshape(-1, dim)
                at = nearest(x, cs[dim])
                codes, length, inner = encode(x, cs[dim][at], rotation(dim, s.seed))
                yield g.assign(cell=at + begin[dim], code=[c.tobytes() for c in codes], length=length, inner=inner)

    index = settle(all_.mapInPandas(coded, "gid long, vector array<double>, dim int, ids array<long>, cell int, code binary, length double, inner double"), "ann-index")
    held = {r["cell"]: r["n"] for r in index.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row per cell
    asked = settle(rows.filter(is_query).select("id", F.xxhash64("vector").alias("gid")).distinct(), "ann-queries")

    def probing(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cs, begin = shared.value
        for p in parts:
            out = []
            for gid, vec, dim in zip(p["gid"], p["vector"], p["dim"], strict=True):
                d = ((cs[dim] - np.array(vec)) ** 2).sum(1)
                order = np.argsort(d, kind="stable") + begin[dim]
                got = np.cumsum([held.get(int(c), 0) for c in order])
                need = max(probe[dim], int(np.searchsorted(got, s.scan)) + 1)
                out += [(gid, vec, int(c)) for c in order[:need] if int(c) in held]
            yield pd.DataFrame(out, columns=["gid", "vector", "cell"])

    queries = index.join(asked.select("gid").distinct(), "gid", "left_semi").select("gid", "vector", "dim")
    probes = settle(queries.mapInPandas(probing, "gid long, vector array<double>, cell int"), "ann-probes")
    wanted = {r["cell"]: r["n"] for r in probes.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row per cell
    blocks = {c: -(-n // s.block) for c, n in held.items()}
    chunks = {c: -(-wanted[c] // s.chunk) for c in wanted}
    cut = spark.createDataFrame([(c, blocks[c], chunks[c]) for c in wanted], "cell int, blocks int, chunks int")
    block, chunk = F.pmod(F.xxhash64("gid", F.lit(1)), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("gid", F.lit(2)), F.col("chunks")).cast("int")
    left = index.join(F.broadcast(cut), "cell").withColumn("block", block).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("blocks", "chunks", "dim")
    right = probes.join(F.broadcast(cut), "cell").withColumn("chunk", chunk).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "chunks")

    def meet(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(x) and len(q):
            cs, begin = shared.value
            v = np.array(x["vector"].tolist())
            dim, cell = v.shape[1], int(x["cell"].iloc[0])
            centre, turn = cs[dim][cell - begin[dim]], rotation(dim, s.seed)
            codes = np.frombuffer(b"".join(x["code"]), np.uint8).reshape(len(x), -1)
            length, inner, gids, ids = x["length"].to_numpy(), x["inner"].to_numpy(), x["gid"].to_numpy(), x["ids"].tolist()
            least = np.array([i[0] for i in ids])
            want = min(s.top + 1, len(x))
            for qid, vec in zip(q["gid"], q["vector"], strict=True):
                vec = np.array(vec)
                guess, low = estimate(codes, length, inner, turn @ (vec - centre), s.epsilon)
                best = np.argpartition(guess, want - 1)[:want]
                worst = ((v[best] - vec) ** 2).sum(1).max()
                near = np.flatnonzero(low <= worst + 1e-9 * (1 + abs(worst)))
                exact = np.sqrt(((v[near] - vec) ** 2).sum(1))
                for k in np.lexsort((least[near], exact))[:want]:
                    out.append((qid, float(exact[k]), int(least[near[k]]), ids[near[k]]))
        return pd.DataFrame(out, columns=["gid", "score", "least", "ids"])

    key = ["cell", "block", "chunk"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(meet, "gid long, score double, least long, ids array<long>")
    order = W.partitionBy("gid").orderBy("score", "least")
    best = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= s.top + 1)
    answers = best.groupBy("gid").agg(F.sort_array(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(F.col("score").alias("score"), i.alias("id")))))).alias("near"))
    own = asked.withColumnRenamed("id", "query_id").join(answers, "gid")
    kept = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, s.top)
    return own.select("query_id", F.posexplode(kept).alias("rank", "x")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("id"), F.col("x.score").alias("score"))

"""Embedding whitening from a covariance of distinct vectors weighted by their multiplicity.

* Entries become whole numbers, ``floor(scale * c) + shift``, as doubles first;
  rows whose vector is null or holds a null or non-finite entry go. Grouping
  by the whole vector gives the distinct vectors and their counts; the counts
  (or one each) are the weights of the fit.
* Sums per dimension are exact, centred products are summed per task as one
  weighted matrix product each, and both are added up by Spark, one row per
  dimension. Only these d and d x d numbers reach the driver, which takes the
  eigenvectors of the d x d covariance.
* Each distinct vector is whitened once, and its result is joined back to the
  rows that hold it by a 256-bit digest of the vector, so that a row moves its
  id and 32 bytes. A vector that holds over 1/200 of all rows is joined under
  many salts; there are at most 200 such.

Memory in a task is a batch and a d x d matrix. Sums of doubles depend in their
last bits on the order in which tasks are added.

Edge cases: vectors of different lengths are fits of their own, one per length;
an empty vector has no component and no row; a fit whose covariance has lower
rank than ``components`` gives its components of nonzero eigenvalue alone (none
if all its vectors are equal), as nothing can be divided by the root of zero;
|64 c| is held to 2^61; a deviation beyond a long is null; null ids, repeated ids
and repeated rows are rows of their own; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle

#: Eigenvalues up to this share of the trace are the rounding of zero.
RANK = 1e-12
#: A vector with over 1/HOT of all rows is salted, one salt for each SALT rows.
HOT, SALT = 200, 10_000
MOST, LONG = 1 << 61, 1 << 63


def whole_numbers(vector: Column, scale: int, shift: int) -> Column:
    """floor(scale * c) + shift of each entry; null if an entry or the vector is null or not finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = lambda c: F.least(F.greatest(F.floor(F.lit(float(scale)) * c.cast("double")), F.lit(-MOST)), F.lit(MOST))
    return F.when(finite, F.transform(vector, lambda c: held(c) + F.lit(shift)))


def by_length(vectors: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places of the vectors of that length, these as a matrix)."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        some = vectors if len(at) == len(vectors) else vectors.take(pa.array(at))
        yield int(d), at, some.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def sums(groups: DataFrame) -> dict[int, tuple[int, list]]:
    """Per length: the sum of weights and the weighted sums per dimension. Whole numbers exactly, of groups (vector, weight, ...)."""
    exact = groups.schema["vector"].dataType == T.ArrayType(T.LongType())
    kind = "decimal(38,0)" if exact else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            weight = b.column("weight").to_numpy()
            for d, at, x in by_length(b.column("vector")):
                w = weight[at]
                if not exact:
                    add = w @ x
                elif float(np.abs(x).max()) * float(w.sum()) < MOST:
                    add = (w @ x).astype(object)
                else:  # beyond longs: Python's whole numbers
                    add = w.astype(object) @ x.astype(object)
                add = np.append(add, int(w.sum()))
                total[d] = total[d] + add if d in total else add
        for d, s in total.items():
            values = pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0)) if exact else pa.array(s.astype(float))
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(s), pa.int32()), pa.array(range(len(s)), pa.int32()), values], ["d", "i", "total"])

    rows = groups.select("vector", "weight").mapInArrow(run, f"d int, i int, total {kind}")
    out: dict[int, dict[int, object]] = {}
    for r in rows.groupBy("d", "i").agg(F.sum("total").cast(kind).alias("total")).collect():  # d numbers and one for each length
        out.setdefault(r.d, {})[r.i] = int(r.total) if exact else r.total
    return {d: (int(s[d]), [s[i] for i in range(d)]) for d, s in out.items()}


@dataclass
class Centre:
    """The mean as a whole number and the rest, so that whole numbers lose nothing to rounding before they are small."""

    near: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(n: int, total: list) -> Centre:
        if all(isinstance(s, int) for s in total):
            near = [(2 * s + n) // (2 * n) for s in total]
            return Centre(np.array(near, np.int64), np.array([(s - m * n) / n for s, m in zip(total, near, strict=True)]))
        return Centre(np.zeros(len(total)), np.array(total) / n)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - self.near) - self.rest


def covariances(groups: DataFrame, fits: dict[int, tuple[int, list]]) -> dict[int, np.ndarray]:
    """Per length: the weighted covariance about the mean, divisor the sum of weights."""
    if not fits:
        return {}
    centres = {d: Centre.of(n, s) for d, (n, s) in fits.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            weight = b.column("weight").to_numpy()
            for d, at, x in by_length(b.column("vector")):
                c = centres[d].apply(x)
                add = (c * weight[at, None]).T @ c
                total[d] = total[d] + add if d in total else add
        for d, g in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(list(g), pa.list_(pa.float64()))], ["d", "i", "line"])

    rows = groups.select("vector", "weight").mapInArrow(run, "d int, i int, line array<double>")
    added = rows.groupBy("d", "i").agg(F.array(*[F.sum(F.get("line", F.lit(k))) for k in range(max(fits))]).alias("line"))
    out = {d: np.zeros((d, d)) for d in fits}
    for r in added.collect():  # the matrix of each length, a line a row
        out[r.d][r.i] = r.line[: r.d]
    return {d: g / fits[d][0] for d, g in out.items()}


@dataclass
class Fit:
    n: int
    total: list[int]
    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @staticmethod
    def of(n: int, total: list[int], covariance: np.ndarray, components: int) -> Fit:
        values, vectors = np.linalg.eigh(covariance)
        trace = float(np.trace(covariance))
        top = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > RANK * trace]
        return Fit(n, total, Centre.of(n, total), vectors[:, top], values[top], values[top] / trace)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exactly."""
        near = self.centre.near
        rest = [s - self.n * int(m) for s, m in zip(self.total, near, strict=True)]
        most = float(np.abs(x - near).max()) * self.n + self.n
        if most * most * x.shape[1] < MOST:
            return ((self.n * (x - near) - np.array(rest, np.int64)) ** 2).sum(1).tolist()
        y = self.n * (x - near).astype(object) - np.array(rest, object)
        return [v if v < LONG else None for v in (y * y).sum(1).tolist()]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (self.centre.apply(x) @ self.vectors) / np.sqrt(self.values)


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32, weights: str = "counts", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(key, n, deviation, whitened: array<double>, explained: array<double>, identity_error) per remaining row.

    ``weights``: "counts" fits on all vectors, "one" on the distinct ones.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights: counts or one")
    spark = rows.sparkSession
    rows = rows.select(F.col(key).alias("id"), whole_numbers(F.col(vector), scale, shift).alias("vector")).filter("size(vector) > 0")
    digest = F.unhex(F.sha2(F.col("vector").cast("string"), 256))
    counted = rows.groupBy("vector").agg(F.count(F.lit(1)).alias("copies"))
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    groups = settle(counted.select(digest.alias("digest"), "vector", "copies", weight.alias("weight")), "distinct-vectors")
    fits = sums(groups)
    fits_of = {d: Fit.of(*fits[d], c, components) for d, c in covariances(groups, fits).items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, at, x in by_length(b.column("vector")):
                fit, some = fits_of[d], b.take(pa.array(at))
                lists = pa.array(list(fit.whiten(x)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [some.column("digest"), some.column("copies"), some.column("weight"), pa.array([d] * len(at), pa.int32()), pa.array(fit.deviation(x), pa.int64()), lists],
                    ["digest", "copies", "weight", "d", "deviation", "whitened"],
                )

    made = groups.mapInArrow(run, "digest binary, copies long, weight long, d int, deviation long, whitened array<double>")
    made = settle(made, "whitened-vectors")
    # the whitened vectors' own covariance; d tells their fits apart
    white = {}
    for d, fit in fits_of.items():
        if len(fit.values):
            of = made.filter(F.col("d") == d).select(F.col("whitened").alias("vector"), "weight")
            (cov,) = covariances(of, sums(of)).values()
            white[d] = float(np.abs(cov - np.eye(len(cov))).max())
    said = [(d, f.n, f.explained.tolist(), white.get(d)) for d, f in fits_of.items()]
    stats = spark.createDataFrame(said, "d int, n long, explained array<double>, identity_error double")  # a row for each length
    total = sum(r.n for r in groups.groupBy().agg(F.sum("copies").alias("n")).collect() if r.n)
    salts = F.when(F.col("copies") * HOT > total, F.ceil(F.col("copies") / SALT)).otherwise(1).cast("int")
    made = made.join(F.broadcast(stats), "d").withColumn("salts", salts)
    hot = F.broadcast(made.filter("salts > 1").select("digest", "salts"))  # fewer than HOT rows
    salted = made.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    ids = rows.select("id", digest.alias("digest")).join(hot, "digest", "left")
    ids = ids.select("id", "digest", F.coalesce(F.pmod(F.xxhash64("id", F.spark_partition_id()), F.col("salts")), F.lit(0)).cast("int").alias("salt"))
    return ids.join(salted, ["digest", "salt"]).select(F.col("id").alias(key), "n", "deviation", "whitened", "explained", "identity_error")


def components(whitened: DataFrame, key: str = "vec_id") -> DataFrame:
    """A row per component, numbered from 1."""
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("p", "c")
    flat = whitened.select(key, "n", "deviation", "identity_error", each)
    return flat.select(key, (F.col("p") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")

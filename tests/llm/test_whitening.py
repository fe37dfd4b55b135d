"""Whitening against a brute-force version over all vectors."""

import math
from collections import defaultdict

import numpy as np
import pytest

from tessel.llm import whitening
from tessel.llm.queries import QUERIES

from .conftest import corpus


def whole(v):
    if v is None or any(c is None or not math.isfinite(c) for c in v):
        return None
    return [math.floor(64 * float(c)) + 1_000_000 for c in v]


def check(got, rows, components, distinct=False):
    """got: rows (id, component, n, deviation, whitened, explained, identity_error)."""
    fits = defaultdict(list)
    for i, v in rows:
        if (x := whole(v)) is not None:
            fits[len(x)].append((i, tuple(x)))
    found = defaultdict(list)
    for r in got:
        found[r.vec_id].append(r)
    expected = 0
    for d, members in fits.items():
        if not d:
            continue
        fit = [x for _, x in members] if not distinct else list({x for _, x in members})
        n, total = len(fit), [sum(x[k] for x in fit) for k in range(d)]
        c = np.array([[x[k] - total[k] / n for k in range(d)] for x in fit])
        cov = c.T @ c / n
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        rank = int((values > 1e-9 * max(1e-300, np.trace(cov))).sum())
        top = min(rank, components)
        expected += top * len(members)
        sign = {}
        for i, x in members:
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, total, strict=True))
            want = np.array([a - s / n for a, s in zip(x, total, strict=True)]) @ vectors[:, :top] / np.sqrt(values[:top])
            own = [r for r in found[i] if r.n == n and r.deviation == deviation]
            assert sorted({r.component for r in own}) == list(range(1, top + 1))
            for r in own:
                k = r.component - 1
                if abs(want[k]) > 1e-4:
                    assert sign.setdefault((d, k), np.sign(r.whitened * want[k])) == np.sign(r.whitened * want[k])
                assert abs(abs(r.whitened) - abs(want[k])) < 1e-6
                assert abs(r.explained - values[k] / np.trace(cov)) < 1e-9
                assert r.identity_error < 1e-6
    assert len(got) == expected


def test_query(spark, small):
    t = corpus()["embeddings"]
    rows = list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist(), strict=True))
    check(QUERIES["op13_whitening"](spark, small).collect(), rows, 32)


def test_real_vectors(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(QUERIES["op13_whitening"](spark, sf).collect(), rows, 32)


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_hot_vector_and_weights(spark, monkeypatch, weights):
    monkeypatch.setattr(whitening, "SALT", 7)
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=5).tolist()) for k in range(120)]
    rows += [(200 + k, rows[3][1]) for k in range(90)] + [(None, rows[4][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, v, "z") for i, v in rows], "vec_id long, embedding array<double>, digest string").repartition(6)
    got = whitening.components(whitening.whiten(df, weights=weights, components=3)).collect()
    assert len(got) == 3 * len(rows)
    fit = [v for _, v in rows] if weights == "counts" else list(map(list, {tuple(whole(v)): v for _, v in rows}.values()))
    assert {r.n for r in got} == {len(fit)}
    x = np.array([whole(v) for v in fit])
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    by = {(r.vec_id, r.component): r for r in got}
    assert np.allclose([by[0, k].explained for k in (1, 2, 3)], values[:3] / values.sum())
    assert by[200, 1].whitened == by[3, 1].whitened and by[0, 1].identity_error < 1e-9


def test_large_entries_and_flat_fits(spark):
    big = [(1, [1e17, 0.0]), (2, [-1e17, 1.0]), (3, [3e38, 2.0]), (4, [0.5, 0.25, 0.125]), (5, [0.5, 0.25, 0.125])]
    df = spark.createDataFrame(big, "vec_id int, embedding array<double>")
    got = whitening.whiten(df).collect()
    flat = {r.vec_id: r for r in got}
    assert sorted(flat) == [1, 2, 3, 4, 5]
    assert flat[4].deviation == 0 and flat[4].whitened == [] and flat[4].identity_error is None
    assert flat[1].deviation is None and all(math.isfinite(x) for x in flat[1].whitened)

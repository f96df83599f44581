"""Whitening: rank-one updates against LAPACK, the whole result against numpy."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wiremap.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def scatter(x):
    return (x - x.mean(0)).T @ (x - x.mean(0))


def same(state, x):
    want = scatter(x)
    size = max(np.abs(want).max(), 1.0)
    assert np.abs((state.basis * state.values) @ state.basis.T - want).max() < 1e-11 * size * x.shape[1]
    assert np.abs(state.basis.T @ state.basis - np.eye(x.shape[1])).max() < 1e-11
    assert state.n == len(x) and (state.sums == x.sum(0)).all()
    assert (np.diff(state.values) >= 0).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 40), st.sampled_from([3, 50, 5000]), st.integers(0, 10_000))
def test_updates_and_merges(dim, n, spread, seed):
    """Small spreads give many ties, few rows a singular scatter: both deflate."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-spread, spread, (n, dim)) * (rng.random(dim) < 0.8) + W.SHIFT
    x[rng.random(n) < 0.3] = x[0]
    one = W.Spectrum.empty(dim)
    one.add(x)
    same(one, x)
    cut = int(rng.integers(0, n + 1))
    a, b = W.Spectrum.empty(dim), W.Spectrum.empty(dim)
    a.add(x[:cut])
    b.add(x[cut:])
    a.merge(b)
    same(a, x)


def test_secular_roots_against_eigenvalues():
    rng = np.random.default_rng(3)
    for k in (2, 5, 40):
        d = np.sort(rng.random(k)) * 10.0 ** rng.integers(-6, 6, k)
        d.sort()
        z = rng.normal(size=k) * 10.0 ** rng.integers(-3, 2, k)
        roots = d - np.diagonal(W.secular_roots(d, z))
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(z, z))
        assert np.abs(roots - want).max() < 1e-12 * want.max()


def plain(rows, k):
    """Rows with ids, whole vectors; numpy's covariance and eigenvectors."""
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    dim = max(len(v) for _, v in rows)
    c = np.array([list(np.float32(v)) + [0.0] * (dim - len(v)) for _, v in rows], float)
    x = np.floor(1024 * c).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    values, axes = np.linalg.eigh(scatter(x) / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    w = (x - s / n) @ axes / np.sqrt(values)
    return [r[0] for r in rows], ((n * x - s) ** 2).sum(1), w, values / np.trace(scatter(x) / n), n


def check(out, rows, k):
    ids, deviation, w, explained, n = plain(rows, k)
    got = out.collect()
    assert len(got) == len(ids) * w.shape[1] and {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    want = {}
    for i, d, line in zip(ids, deviation.tolist(), w):
        for c, value in enumerate(line, 1):
            want.setdefault((i, d), {}).setdefault(c, []).append(value)
    assert by.keys() == want.keys()
    for c in range(1, w.shape[1] + 1):
        keys = sorted(want, key=str)
        a = np.concatenate([np.sort(by[key][c]) for key in keys])
        b, m = (np.concatenate([np.sort(f * np.array(want[key][c])) for key in keys]) for f in (1, -1))
        assert min(np.abs(a - b).max(), np.abs(a - m).max()) < 1e-8


def test_matches_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=10).tolist()) for i in range(300)]
    rows += [(None, rng.normal(size=10).tolist()), (7, rng.normal(size=10).tolist()), (8, rows[8][1]),
             (900, None), (901, [None] * 10), (902, [float("nan")] * 10), (903, [float("inf")] + [0.0] * 9),
             (904, [0.5, 1.0]), (905, []), (906, [0.0] * 10)]
    data = spark.createDataFrame(rows, SCHEMA).repartition(19)
    clash = data.select("*", *[F.lit("clash").alias(c) for c in ("v", "w", "n", "part", "component", "basis")])
    check(W.whiten(clash), rows, 8)


def test_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    check(W.whiten(rows), [tuple(r) for r in rows.collect()], 8)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, []), (2, [])], [(1, [float("nan")])]])
def test_nothing_to_whiten(spark, rows):
    out = W.whiten(spark.createDataFrame(rows, SCHEMA))
    assert out.collect() == [] and out.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_no_variance(spark):
    one = W.whiten(spark.createDataFrame([(1, [0.5, 0.25])] * 3, SCHEMA)).collect()
    assert len(one) == 6 and {(r.whitened, r.deviation, r.explained, r.identity_error) for r in one} == {(None, 0, 0.0, 0.0)}
    line = W.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (2, [1.5, 0.25])], SCHEMA)).collect()
    assert sorted((r.component, r.whitened is None) for r in line) == [(1, False), (1, False), (2, True), (2, True)]


def test_deviation_beyond_64_bits():
    x = np.array([[10 ** 6], [-10 ** 6]])
    assert W._deviation(x, np.array([0]), 10 ** 4) == [None, None]
    assert W._deviation(x, np.array([0]), 1000) == [10 ** 18, 10 ** 18]

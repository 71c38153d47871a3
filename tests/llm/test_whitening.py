"""Whitening against plain eigenvectors of the plain covariance."""

import math

import numpy as np
import pytest
from conftest import MEDIUM

from eventmill.llm import whitening
from eventmill.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int, n long, x string, component string"


def rows_of(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, 0, 7, "x", "c") for i, v in zip(ids or range(len(vectors)), vectors)], SCHEMA)


def plain(vectors, most=16):
    """n, sums, components (columns), eigenvalues and trace of one length of vectors."""
    x = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, turn = np.linalg.eigh(y.T @ y / n)
    return x, n, sums, turn[:, ::-1][:, :most], values[::-1][:most], values.sum()


def compare(rows, vectors, ids=None, most=16, close=1e-9):
    x, n, sums, components, values, trace = plain(vectors, most)
    by_key = {}
    for r in rows:
        by_key.setdefault(r.vec_id, {})[r.component] = r
    k = sum(v > 1e-9 * values[0] for v in values)
    assert len(by_key) == len(vectors) and all(sorted(r) == list(range(1, k + 1)) for r in by_key.values())
    ids = ids or list(range(len(vectors)))
    for j in range(k):
        sign = 0
        for i, v in zip(ids, x):
            r = by_key[i][j + 1]
            want = sum((n * c - s) / n * components[d, j] for d, (c, s) in enumerate(zip(v, sums))) / math.sqrt(values[j])
            if not sign and abs(want) > 1e-3:
                sign = 1 if want * r.whitened > 0 else -1
            assert abs(r.whitened - sign * want) < close and r.n == n and abs(r.explained - values[j] / trace) < 1e-9 * r.explained
            assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(v, sums)) and r.identity_error < 1e-9


@pytest.mark.parametrize("seed", range(20))
def test_roots(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 40))
    poles = np.sort(rng.choice([rng.random(n), rng.random(n) ** 8, np.arange(n) * 10.0 ** -seed + 1]))
    poles = np.unique(poles)
    parts = rng.normal(size=len(poles)) * 10.0 ** rng.integers(-6, 3, len(poles))
    if len(poles) < 2:
        return
    origin, x = whitening.secular_roots(poles, parts * parts)
    want = np.linalg.eigvalsh(np.diag(poles) + np.outer(parts, parts))
    assert np.allclose(poles[origin] + x, want, rtol=1e-12, atol=1e-13 * want[-1])
    assert (np.diff(poles[origin] + x) >= 0).all() and (poles[origin] + x >= poles).all()


@pytest.mark.parametrize("kind", ["whole", "few", "repeated", "integers", "constant", "graded"])
def test_rank_one_updates(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 12))
    if kind == "few":
        x = x[:5]
    elif kind == "repeated":
        x[50:] = x[:150] * 0 + x[0]
    elif kind == "integers":
        x = rng.integers(-1, 2, (200, 12)).astype(float)
    elif kind == "constant":
        x[:, 3:9] = 2.5
    elif kind == "graded":
        x *= 10.0 ** -np.arange(12)
    s, halves = whitening.Spectrum(12), [whitening.Spectrum(12), whitening.Spectrum(12)]
    for i, v in enumerate(x):
        s.add(v)
        halves[i % 2].add(v)
    halves[0].merge(halves[1])
    y = x - x.mean(0)
    for each in (s, halves[0]):
        assert each.n == len(x) and np.allclose(each.mean, x.mean(0))
        assert np.allclose(each.vectors.T @ each.vectors, np.eye(12), atol=1e-11)
        assert np.allclose((each.vectors * each.values) @ each.vectors.T, y.T @ y, atol=1e-11 * np.trace(y.T @ y))


def test_against_plain_eigenvectors(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(400, 20)) * np.linspace(2, 0.3, 20)).tolist()
    vectors += [vectors[0]] * 100 + [[c + 1e-9 for c in vectors[1]]]
    rows = whitening.whiten(rows_of(spark, vectors).repartition(7)).collect()
    assert rows[0].__fields__ == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(rows, vectors)


def test_many_spectra_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(2)
    x = rng.integers(-500, 500, (300, 6))
    fit = spark.createDataFrame([(v,) for v in x.tolist()], "x array<long>").repartition(11)
    s = whitening.spectrum_of(fit, 6)
    y = x - x.mean(0)
    assert s.n == 300 and np.allclose((s.vectors * s.values) @ s.vectors.T, y.T @ y, rtol=1e-10)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, 0.25, -1.0], [0.5, 0.75, 1.0], [-0.5, 0.1, 0.0], [0.5, 0.25, -1.0], [3.0, 0.2, 0.4]]
    bad = [None, [1.0, None, 2.0], [nan, 1.0, 2.0], [inf, 1.0, 2.0], [1.0, -inf, 0.0], []]
    rows = whitening.whiten(rows_of(spark, good + bad)).collect()
    compare(rows, good)
    assert whitening.whiten(rows_of(spark, [])).collect() == []
    assert whitening.whiten(rows_of(spark, bad)).collect() == []
    assert whitening.whiten(rows_of(spark, [[1.0, 2.0]] * 3)).collect() == []  # no variance
    two = whitening.whiten(rows_of(spark, [[1.0, 2.0, 3.0], [2.0, 2.0, 3.0], [5.0], [7.0], [9.0]])).collect()
    assert {(r.vec_id, r.n) for r in two} == {(0, 2), (1, 2), (2, 3), (3, 3), (4, 3)} and all(r.component == 1 for r in two)
    same_id = whitening.whiten(rows_of(spark, [[1.0], [2.0], [2.0]], ids=[1, 1, None])).collect()
    assert sorted(map(str, (r.vec_id for r in same_id))) == ["1", "1", "None"]


def test_large_entries(spark):
    vectors = [[1e12, 0.0], [-3e12, 1.0], [2e12, 2.0], [5e9, -1e12]]
    rows = whitening.whiten(rows_of(spark, vectors)).collect()
    x, n, sums, *_ = plain(vectors)
    for r in rows:
        exact = sum((n * c - s) ** 2 for c, s in zip(x[r.vec_id], sums))
        assert r.deviation == (exact if exact < 1 << 63 else None) and abs(r.whitened) < 10
    assert len(whitening.whiten(rows_of(spark, [[1e300, 0.0], [0.0, 1.0]])).collect()) == 2


def test_table(spark):
    embeddings = table(spark, MEDIUM, "embeddings")
    given = embeddings.collect()
    vectors = [list(map(float, r.embedding)) for r in given]
    compare(whitening.whiten(embeddings).collect(), vectors, [r.vec_id for r in given], close=1e-8)

"""Whitening against a plain eigendecomposition, and the refinement alone."""

import math
import random

import numpy as np
import pytest

from opsframe.llm import whitening
from opsframe.llm.whitening import components, refined, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, n string"


def plain(vectors, most=32):
    x = np.floor(64 * np.array(vectors, np.float64)) + 1_000_000
    n = len(x)
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    order = np.argsort(-e)
    e, q = e[order], q[:, order]
    keep = [i for i in range(len(e)) if e[i] > 1e-12 * np.trace(v)][:most]
    dev = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    return centred @ q[:, keep] / np.sqrt(e[keep]), e[keep] / np.trace(v), dev


def rows(spark, vectors, extra=()):
    data = [(i, [float(c) for c in v], 0, "clash") for i, v in enumerate(vectors)]
    data += list(extra)
    return spark.createDataFrame(data, SCHEMA)


def check(found, vectors):
    want, explained, dev = plain(vectors)
    got = {}
    for r in found:
        got[(r.vec_id, r.component)] = r
    k = want.shape[1]
    assert len(got) == len(vectors) * k
    signs = [
        np.sign(got[(0, c + 1)].whitened * want[0, c]) or 1.0 for c in range(k)
    ]
    for (i, c), r in got.items():
        assert r.n == len(vectors)
        assert r.deviation == int(dev[i])
        assert r.whitened == pytest.approx(signs[c - 1] * want[i, c - 1], abs=1e-6)
        assert r.explained == pytest.approx(explained[c - 1], rel=1e-6)
        assert r.identity_error <= 1e-4


def test_matches_plain_version(spark):
    rng = np.random.default_rng(3)
    basis = rng.normal(size=(8, 8))
    vectors = (rng.normal(size=(300, 8)) * np.arange(1, 9)) @ basis / 20
    check(whiten(rows(spark, vectors.tolist()).repartition(5)).collect(),
          vectors.astype(np.float32).tolist())


def test_dirty_rows_are_dropped(spark):
    rng = random.Random(1)
    vectors = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(50)]
    bad = [
        (900, None, 0, "x"), (901, [1.0, None, 0.0, 0.0], 0, "x"),
        (902, [math.nan, 0.0, 0.0, 0.0], 0, "x"),
        (903, [math.inf, 0.0, 0.0, 0.0], 0, "x"),
    ]
    found = whiten(rows(spark, vectors, bad)).collect()
    assert {r.vec_id for r in found} == set(range(50))
    check(found, np.array(vectors, np.float32).tolist())


def test_repeated_rows_and_ties(spark):
    vectors = [[1, 0, 0], [0, 1, 0], [0, 0, 1], [-1, 0, 0], [0, -1, 0],
               [0, 0, -1]] * 3
    found = whiten(rows(spark, vectors)).collect()
    assert {r.component for r in found} == {1, 2, 3}
    assert max(r.identity_error for r in found) <= 1e-4
    assert {round(r.explained, 9) for r in found} == {round(1 / 3, 9)}


def test_empty_and_degenerate(spark):
    assert whiten(rows(spark, [])).count() == 0
    assert whiten(rows(spark, [[0.5, 0.5]] * 4)).count() == 0
    assert whiten(rows(spark, [], [(1, None, 0, "x")])).count() == 0


def test_more_components_than_kept(spark, monkeypatch):
    monkeypatch.setattr(whitening, "COMPONENTS", 2)
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(60, 5)) * np.arange(1, 6)).tolist()
    found = whiten(rows(spark, vectors)).collect()
    assert {r.component for r in found} == {1, 2}


@pytest.mark.parametrize("seed", range(5))
def test_refinement_with_clusters(seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    lam = np.array([5, 5, 5 + 1e-9, 3, 3, 2, 1, 1e-3, 1e-3, 0.5, 0.25, 4.0])
    a = (q * lam) @ q.T
    a = (a + a.T) / 2
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    got_lam, x = refined(a, start)
    x = x.astype(np.float64)
    assert np.abs(x.T @ x - np.eye(12)).max() < 1e-13
    assert np.abs(a @ x - x * got_lam.astype(np.float64)).max() < 1e-12
    assert np.allclose(np.sort(got_lam.astype(float)), np.sort(lam), atol=1e-12)


def test_components_from_exact_sums():
    y = np.array([[1, 2], [3, 5], [0, -1], [2, 2]], dtype=np.int64)
    lam, vec, trace = components(len(y), y.sum(axis=0).astype(object),
                                 (y.T @ y).astype(object))
    v = np.cov(y.T, bias=True)
    assert float(trace) == pytest.approx(np.trace(v))
    assert np.allclose(np.sort(lam.astype(float)), np.linalg.eigvalsh(v))

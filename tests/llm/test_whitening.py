"""Embedding whitening against eigenvectors of the covariance."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm.whitening import Centre, bidiagonalise, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(vectors):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n = len(x)
    d = n * x - x.sum(axis=0)
    centred = d / n
    e, comp = np.linalg.eigh(centred.T @ centred / n)
    return n, (d * d).sum(axis=1), centred, e[::-1], comp[:, ::-1]


def local_step(x):
    return lambda g, q: ((x @ q).T @ (w := x @ g), float(w @ w), x.T @ w, float((x * x).sum()))


def check(got, vectors, components):
    n, deviation, centred, e, comp = expected([v for _, v in vectors])
    assert len(got) == n * components
    assert {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, components + 1))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9
    order = {i: k for k, (i, _) in enumerate(vectors)}
    white = np.zeros((n, components))
    for r in got:
        white[order[r.vec_id], r.component - 1] = r.whitened
        assert int(r.deviation) == deviation[order[r.vec_id]]
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9)
    want = centred @ comp[:, :components] / np.sqrt(e[:components])
    signs = np.sign((white * want).sum(axis=0))
    return np.abs(white - signs * want).max()


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(20, 20)) * np.linspace(2, 0.1, 20)
    vectors = [(i, (rng.normal(size=20) @ mix).astype(np.float32).tolist()) for i in range(300)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(150)]  # a third are copies
    bad = [(5000, None), (5001, [None] + [0.0] * 19), (5002, [float("nan")] * 20), (5003, [float("inf")] + [1.0] * 19), (5004, [1.0] * 3), (5005, []), (5006, [3e38] * 20)]
    table = spark.createDataFrame([(i, v, 0) for i, v in vectors + bad], SCHEMA).withColumn("x", F.lit(1)).withColumn("component", F.lit(9)).repartition(5)
    assert check(whiten(table).collect(), vectors, 8) < 1e-9


def test_whitening_leaves_out_what_does_not_vary(spark):
    """Three dimensions that vary in two directions; repeated ids and rows count each time."""
    rng = np.random.default_rng(5)
    plane = [(i, [float(a), float(b), float(a)]) for i, (a, b) in enumerate(rng.integers(-9, 9, size=(40, 2)))]
    rows = spark.createDataFrame([(i, v, 0) for i, v in plane], SCHEMA)
    assert check(whiten(rows).collect(), plane, 2) < 1e-9
    twice = whiten(rows.unionByName(rows)).collect()
    assert len(twice) == 160 and {r.n for r in twice} == {80}
    assert whiten(rows.filter("vec_id < 1")).collect() == []
    assert whiten(rows.filter("vec_id < 0")).collect() == []
    assert whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect() == []


def test_bidiagonalisation_finds_multiple_and_distant_variances():
    rng = np.random.default_rng(8)
    for values in ([5, 5, 5, 4, 3, 3, 2, 1, 1, 1, 0, 0], [1e6, 1e6, 10, 10, 1e-2, 1e-2, 1e-3, 0], [1] * 16, [7] + [0] * 11):
        d = len(values)
        u, _ = np.linalg.qr(rng.normal(size=(60, d)))
        w, _ = np.linalg.qr(rng.normal(size=(d, d)))
        x = u * np.array(values) @ w.T
        v, b, squares = bidiagonalise(local_step(x), d)
        assert np.abs(v.T @ v - np.eye(d)).max() < 1e-12
        assert np.count_nonzero(np.triu(b, 2)) == np.count_nonzero(np.tril(b, -1)) == 0
        assert np.linalg.svd(b)[1] == pytest.approx(sorted(map(float, values), reverse=True), rel=1e-9, abs=1e-8 * max(values))
        assert squares == pytest.approx(sum(x * x for x in values))


def test_centring_is_exact_beyond_64_bits():
    x = np.array([[2**50, 3], [-(2**50), 4]])
    wide = Centre(10**9, [7, 10**12], 2**50)
    assert wide.deviations(x).tolist() == [[10**9 * 2**50 - 7, 3 * 10**9 - 10**12], [-(10**9) * 2**50 - 7, 4 * 10**9 - 10**12]]
    assert wide.square_sums(x)[0] == (10**9 * 2**50 - 7) ** 2 + (3 * 10**9 - 10**12) ** 2
    assert Centre(2, [0, 7], 2**50).square_sums(x)[0] == 4 * 2**100 + 1

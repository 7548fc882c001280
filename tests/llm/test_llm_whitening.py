import math

import numpy as np
import pytest

from tickloom.llm.bidiagonal import bidiagonalise, right_singular, squared_singular_values
from tickloom.llm.whitening import MERGED, triangle, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, x string"


def turned(values, seed, n):
    draw = np.random.default_rng(seed)
    q, p = (np.linalg.qr(draw.normal(size=(n, n)))[0] for _ in range(2))
    return q @ np.diag(values) @ p


CASES = {
    "random": np.random.default_rng(0).normal(size=(40, 40)), "triangle": np.linalg.qr(np.random.default_rng(1).normal(size=(500, 64)))[1],
    "one": np.array([[2.0]]), "zero": np.zeros((5, 5)), "identity": np.eye(6), "rank one": np.ones((7, 7)), "diagonal": np.diag([3.0, 3, 2, 2, 1, 0]),
    "clusters": turned([5.0] * 10 + [4.0] * 10 + [0.0] * 10, 2, 30), "graded": turned(10.0 ** -np.arange(0, 15, 0.5), 3, 30),
    "close pairs": np.diag(np.abs(np.arange(21.0) - 10) + 1e-3) + np.diag(np.ones(20), 1), "negative": -turned(np.arange(1.0, 13), 4, 12),
}


@pytest.mark.parametrize("name", CASES)
def test_singular_values_and_vectors(name):
    m = CASES[name]
    n = m.shape[1]
    values, vectors = right_singular(m, n)
    want = np.linalg.svd(m, compute_uv=False) ** 2
    scale = max(want[0], 1e-300)
    assert np.abs(values - want).max() < 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-11
    assert np.abs(m.T @ (m @ vectors) - vectors * values).max() < 1e-13 * scale
    a, b, v = bidiagonalise(m)
    assert np.allclose(v @ (np.diag(a) + np.diag(b, 1)).T @ (np.diag(a) + np.diag(b, 1)) @ v.T, m.T @ m, atol=1e-12 * scale)


def test_small_singular_values_are_accurate():
    a = 10.0 ** -np.arange(12.0)
    values = squared_singular_values(a, a[:-1] / 2)
    assert abs(np.prod(values) / np.prod(a ** 2) - 1) < 1e-12


def plain(rows, k=4):
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array([s / n for s in total])
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    out = {}
    for at, (i, x) in enumerate(kept):
        out[at] = i, n, sum((n * c - s) ** 2 for c, s in zip(x, total)), (np.array(x) - np.array(total) / n) @ axes[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()
    return out


def rows_of(df):
    got = {}
    for r in df.collect():
        got.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    return got


def test_whitening_equals_the_eigenvectors(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in draw.normal(size=12) * np.arange(12, 0, -1) / 12]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(200)]                                         # a hot vector counts once
    rows += [(1000, None), (1001, [1.0, None] * 6), (1002, [float("nan")] * 12), (1003, [float("inf")] + [0.0] * 11), (1004, []), (1005, [-0.0] * 12)]
    df = spark.createDataFrame([(i, v, 0, "c", "n", "x") for i, v in rows], SCHEMA)
    got, want = rows_of(whiten(df)), plain(rows)
    assert sum(map(len, got.values())) == 4 * len(want)
    sign = None
    for i, n, deviation, whitened, explained in want.values():
        mine = sorted(got[i, deviation], key=lambda r: r["component"])
        assert [r["component"] for r in mine] == [1, 2, 3, 4] and {r["n"] for r in mine} == {n}
        values = np.array([r["whitened"] for r in mine])
        sign = np.sign(values * whitened) if sign is None else sign
        assert np.abs(values - sign * whitened).max() < 1e-9
        assert np.abs([r["explained"] for r in mine] - explained).max() < 1e-12
        assert all(r["identity_error"] < 1e-10 for r in mine)


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = plain([(r["vec_id"], r["embedding"]) for r in df.collect()])
    got = rows_of(whiten(df))
    for i, n, deviation, whitened, _ in want.values():
        assert np.abs(np.abs([r["whitened"] for r in sorted(got[i, deviation], key=lambda r: r["component"])]) - np.abs(whitened)).max() < 1e-9


def test_odd_tables(spark):
    make = lambda *rows: spark.createDataFrame([(i, v, 0, "c", "n", "x") for i, v in rows], SCHEMA)
    assert whiten(make()).count() == 0
    assert whiten(make((1, None), (2, []), (3, [None]))).count() == 0
    assert whiten(make((1, [1.0, 2.0]), (2, [1.0, 2.0]))).count() == 0                          # nothing varies
    one = whiten(make((1, [1.0, 2.0]), (2, [1.0, 3.0]), (None, [1.0, 3.0]), (4, [9.0]))).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"], r["deviation"], round(abs(r["whitened"]), 9)) for r in one) == [(0, 1, 2, 65536, 1.0), (1, 1, 2, 65536, 1.0), (2, 1, 2, 65536, 1.0)]
    huge = whiten(make((1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [3e9, 1.0]))).collect()
    assert all(r["deviation"] is None for r in huge if r["vec_id"] < 3) and {r["n"] for r in huge} == {3}


def test_triangles_are_merged_in_rounds(spark):
    draw = np.random.default_rng(6)
    x = draw.integers(-50, 50, (400, 5))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>").repartition(MERGED + 9)
    mean = x.mean(axis=0)
    r = triangle(df, mean)
    assert np.allclose(r.T @ r, (x - mean).T @ (x - mean))

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import SF_DIRS

from pulsegrid.llm import whitening as W

ROWS = "vec_id long, embedding array<float>, x long, n string"


def frame(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, v, 0, "n") for i, v in vectors], ROWS.replace("float", kind))


def plain(rows):
    """x, n, S and the covariance in fractions' precision (float64 at the end) of (id, vector) rows."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    v = [[Fraction(n * sum((r[i] * n - s[i]) * (r[j] * n - s[j]) for r in x), n**4) for j in range(d)] for i in range(d)]
    return x, n, s, v


def check(got, rows, components=32):
    x, n, s, v = plain(rows)
    d = len(s)
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in r] for r in v]))
    values, vectors = values[::-1], vectors[:, ::-1]
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    k = min(components, d)
    assert len(got) == n * k
    signs = {}
    for (i, _), row in zip(rows, x, strict=True):
        for c in range(1, k + 1):
            r = by[i][c]
            assert r["n"] == n and r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(row, s, strict=True))
            assert abs(r["explained"] - values[c - 1] / values.sum()) <= 1e-9 * r["explained"]
            want = float(np.dot(np.array([float(Fraction(n * a - b, n)) for a, b in zip(row, s, strict=True)]), vectors[:, c - 1])) / math.sqrt(values[c - 1])
            if abs(want) > 1e-3:
                signs.setdefault(c, math.copysign(1, want * r["whitened"]))
            assert abs(r["whitened"] * signs.get(c, 1) - want) < 1e-6
        assert 0 <= r["identity_error"] <= 1e-8


def test_against_plain_fractions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * [5, 4, 3, 2, 1, 0.5] + 7).astype(np.float32).tolist()) for i in range(90)]
    rows += [(1000 + i, v) for i, v in rows[:9]]
    check(W.whiten(frame(spark, rows).repartition(5)).collect(), rows)


def test_whole_table(spark):
    table = spark.read.parquet(SF_DIRS["0.001"] + "/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = W.query(spark, SF_DIRS["0.001"]).collect()
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows], np.float64)
    y = x - x.mean(axis=0)
    values = np.linalg.eigvalsh(y.T @ y / len(y))[::-1]
    z = np.full((len(rows), 32), np.nan)
    place = {i: k for k, (i, _) in enumerate(rows)}
    for r in got:
        z[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    assert len(got) == len(rows) * 32
    assert np.abs(z.T @ z / len(z) - np.eye(32)).max() < 1e-9 and max(r["identity_error"] for r in got) < 1e-9
    assert np.allclose([r["explained"] for r in got[:32]], values[:32] / values.sum(), rtol=1e-9)
    # each component is an eigenvector: covariance times direction is eigenvalue times direction
    direction = y.T @ z / len(z) / np.sqrt(values[:32])
    assert np.abs(y.T @ (y @ direction) / len(y) - direction * values[:32]).max() < 1e-8 * values[0]


BAD = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [1.0, float("inf"), 2.0], [1.0, 3e38, 2.0], [1.0, 2.0]]


def test_rows_that_take_no_part(spark):
    good = [(1, [1.0, 2.0, 5.0]), (1, [1.0, 2.0, 5.0]), (2, [3.0, -2.0, 1.0]), (None, [0.5, 8.0, 0.0]), (4, [9.0, 1.0, 1.5])]
    got = W.whiten(frame(spark, good + [(100 + k, v) for k, v in enumerate(BAD)])).collect()
    x, n, s, _ = plain(good)
    assert len(got) == 5 * 3 and {r["vec_id"] for r in got} == {1, 2, None, 4} and {r["n"] for r in got} == {5}
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x)


def test_no_rows_and_no_variance(spark):
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [(1, None)])).count() == 0
    for vectors in ([(1, [2.0, 3.0])], [(i, [2.0, 3.0]) for i in range(5)]):
        got = W.whiten(frame(spark, vectors)).collect()
        assert len(got) == 2 * len(vectors)
        assert all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 and r["identity_error"] == 0 for r in got)
    # fewer rows than dimensions: the components left over have no variance
    got = W.whiten(frame(spark, [(1, [1.0, 0.0, 0.0]), (2, [0.0, 4.0, 0.0])])).collect()
    assert sorted({r["component"] for r in got if r["whitened"] is not None}) == [1]


def test_wide_values(spark):
    """Entries of very different sizes, means far from 0, deviations beyond a long."""
    rng = np.random.default_rng(8)
    rows = [(i, [1e9 + float(rng.normal()) * 1e4, float(rng.normal()), -3e7 + float(rng.normal()) * 50]) for i in range(60)]
    check(W.whiten(frame(spark, rows, "double")).collect(), rows)
    huge = [(1, [1e16, 1.0]), (2, [-1e16, 1.5])]
    assert [r["deviation"] for r in W.whiten(frame(spark, huge, "double")).collect()] == [None] * 4


def test_gram_is_exact():
    rng = np.random.default_rng(1)
    for top in (5, 1 << 18, 1 << 30, 1 << 61):
        y = rng.integers(-top, top, size=(9000, 3))
        want = y.astype(object).T @ y.astype(object)
        assert (W.exact_gram(y) == want).all()


def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0].astype(W.Wide)
    for _ in range(3):  # orthonormal to extended precision
        q = q + q @ ((np.eye(len(values), dtype=W.Wide) - q.T @ q) / 2)
    return q, (q * np.array(values, W.Wide)) @ q.T


CLUSTERS = {
    "apart": np.linspace(1, 40, 30), "within float32": [1 + k * 1e-9 for k in range(8)] + [5.0, 9.0],
    "two clusters": [3 + k * 1e-10 for k in range(6)] + [7 - k * 1e-11 for k in range(6)] + [20.0], "equal": [2.0] * 5 + [1.0] * 5,
    "all near": [1 + k * 1e-12 for k in range(12)], "wide range": [10.0**-k for k in range(12)], "nested": [1, 1 + 1e-5, 1 + 2e-5, 1 + 2e-5 + 1e-11, 4.0],
}


@pytest.mark.parametrize("name", CLUSTERS)
def test_eigenvectors(name):
    want = np.sort(np.array(CLUSTERS[name], W.Wide))[::-1]
    q, v = spectrum(np.array(CLUSTERS[name]))
    x, values = W.eigenvectors((v + v.T) / 2)
    assert np.abs(x.T @ x - np.eye(len(want))).max() < 1e-15 * len(want)
    assert np.abs(values - want).max() < 1e-16 * want[0] * len(want)
    # residuals at double precision or better, though the start was float32
    assert np.abs(v @ x - x * values).max() < 1e-15 * want[0]
    if name in ("apart", "nested"):
        true = q[:, np.argsort(-np.array(CLUSTERS[name], W.Wide))]
        assert np.abs(np.abs((true * x).sum(axis=0)) - 1).max() < 1e-12


def test_clashing_columns(spark):
    rows = frame(spark, [(k, [float(k), float(k * k % 7)]) for k in range(10)]).withColumns({c: F.lit("?") for c in ("deviation", "component", "size", "i")})
    assert W.whiten(rows).count() == 20

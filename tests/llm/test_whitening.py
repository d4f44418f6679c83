"""Whitening against exact plain sums and a numerical eigenvalue solver."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from daytally.llm import charpoly, whitening as wh
from daytally.llm.common import table

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def plain(rows, d, most=8):
    """(n, deviations by row, eigenvalues of V, vectors, trace) of the usable rows."""
    use = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows
           if v is not None and len(v) == d and all(c is not None and abs(c) < 2 ** 52 for c in v)]
    n = len(use)
    sums = [sum(x[j] for _, x in use) for j in range(d)]
    cov = [[sum((Fraction(x[a]) - Fraction(sums[a], n)) * (Fraction(x[b]) - Fraction(sums[b], n)) for _, x in use) / n
            for b in range(d)] for a in range(d)]
    w, v = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    far = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in use]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    return n, far, w[::-1][:most], v.T[::-1][:most], float(sum(cov[a][a] for a in range(d))), np.array([x for _, x in use]) - mean


def check(spark, rows, d, components):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *[F.lit("?").alias(c) for c in ("x", "label", "n", "d", "component", "whitened", "deviation", "i", "j")])
    got = wh.whiten(vectors.repartition(3)).collect()
    n, far, values, axes, trace, centred = plain(rows, d)
    assert len(got) == n * components and {r["component"] for r in got} == set(range(1, components + 1))
    assert all(r["n"] == n for r in got)
    assert sorted((r["vec_id"] or -1, int(r["deviation"])) for r in got if r["component"] == 1) == sorted((i or -1, f) for i, f in far)
    for k in range(components):
        mine = sorted(r["whitened"] for r in got if r["component"] == k + 1)
        assert list({r["explained"] for r in got if r["component"] == k + 1}) == [pytest.approx(values[k] / trace, rel=1e-9)]
        alone = all(abs(values[k] - values[j]) > 1e-6 * values[0] for j in range(len(values)) if j != k)
        if alone:
            want = centred @ axes[k] / math.sqrt(values[k])
            assert np.allclose(mine, sorted(want), atol=1e-7) or np.allclose(mine, sorted(-want), atol=1e-7)
        assert abs(np.mean(mine)) < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-8
    return got


def test_random_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=12) * np.arange(1, 13)).tolist()) for i in range(300)]
    check(spark, rows, 12, 8)


def test_awkward_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    rows += [rows[3], rows[3], (None, rows[4][1]), (100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [NAN, 0.0, 0.0, 0.0, 0.0]),
             (104, [0.0, -INF, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0, 0.0, 0.0]), (107, [1e7, -1e7, 1e9, 0.0, 3e-9])]
    check(spark, rows, 5, 5)


def test_low_rank_and_equal_variances(spark):
    rng = np.random.default_rng(3)
    thin = [(i, [a, 2 * a, b, a + b, 0.0]) for i, (a, b) in enumerate(rng.integers(-4, 5, (30, 2)).astype(float).tolist())]
    check(spark, thin, 5, 2)
    corners = [(i, [float(i == j) - float(i == j + 4) for j in range(4)]) for i in range(8)]
    got = check(spark, corners, 4, 4)
    assert {round(r["explained"], 12) for r in got} == {0.25}


def test_without_variance_or_rows(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert wh.whiten(frame([])).count() == 0
    assert wh.whiten(frame([(1, None), (2, [NAN])])).count() == 0
    assert wh.whiten(frame([(1, [0.5, 0.25])])).count() == 0
    assert wh.whiten(frame([(1, [0.5, 0.25]), (2, [0.5, 0.25])])).count() == 0
    one = wh.whiten(frame([(1, [0.0]), (2, [1.0])])).collect()
    assert sorted(r["whitened"] for r in one) == [-1, 1] and {r["explained"] for r in one} == {1}


def test_the_given_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF, "embeddings").collect()]
    got = wh.op13_whitening(spark, SF).collect()
    n, far, values, axes, trace, centred = plain(rows, 64)
    assert len(got) == 8 * n and {(r["vec_id"], r["deviation"]) for r in got} == set(far)
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    ids = [i for i, _ in far]
    for k in range(8):
        want, mine = centred @ axes[k] / math.sqrt(values[k]), np.array([by[i, k + 1] for i in ids])
        assert min(abs(mine - want).max(), abs(mine + want).max()) < 1e-6
        assert list({r["explained"] for r in got if r["component"] == k + 1}) == [pytest.approx(values[k] / trace, rel=1e-9)]
    assert got[0]["identity_error"] < 1e-8


def leverrier(a):
    """Characteristic polynomial in fractions, lowest coefficient first."""
    d = len(a)
    m, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        out.append(-sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) / k)
    return [int(c) for c in reversed(out)]


@pytest.mark.parametrize("d", [1, 2, 3, 7, 10])
def test_polynomial_is_exact(d):
    rng = np.random.default_rng(d)
    x = rng.integers(-10 ** 6, 10 ** 6, (d + 1, d)).astype(object)
    x[:, -1] = x[:, 0] if d > 3 else x[:, -1]
    a = x.T @ x
    parts = [(p, charpoly.residues(a, p).tolist()) for p in charpoly.primes_for(int(np.trace(a)), d)]
    poly = charpoly.combined(parts)
    assert poly == leverrier(a.tolist())
    roots = charpoly.largest_roots(poly, d)
    assert sum(m for _, m in roots) == d - (d > 3)
    fine = [c << charpoly.ROOT_BITS * (d - i) for i, c in enumerate(poly)]
    for root, _ in roots:
        assert charpoly.value(fine, root) * charpoly.value(fine, root - 1) <= 0


def test_sums_are_exact_for_large_entries():
    x = np.array([[2 ** 61, -2 ** 61, 5], [-2 ** 60 + 1, 2 ** 47, -1], [3, 70_000, -70_000]], np.int64)
    assert (wh.gram(x) == x.astype(object).T @ x.astype(object)).all()

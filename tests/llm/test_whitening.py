"""Whitening against whole-number arithmetic and numpy's eigenvectors."""

import numpy as np
import pytest

from pressmill.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x int, d string, component int, n long"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, "d", 3, 4) for i, v in vectors], SCHEMA).repartition(3)


def plain(vectors, most=16):
    """{id: (n, deviation, whitened)}, explained; from exact sums and eigh."""
    x = {}
    for i, v in vectors:
        if v is not None and len(v) and all(c is not None and np.isfinite(np.float32(c)) for c in v):
            x.setdefault(i, [int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v])
    fit = sorted(set(map(tuple, x.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {i: (n, sum((n * c - s) ** 2 for c, s in zip(row, sums)),
               np.array([(n * c - s) / n for c, s in zip(row, sums)]) @ vectors / np.sqrt(np.maximum(values, 1e-300))) for i, row in x.items()}
    return out, values / values.sum()


def test_whitening(spark):
    draw = np.random.default_rng(3)
    spread = np.linspace(3, 0.2, 20)
    vectors = [(i, [float(c) for c in draw.standard_normal(20) * spread + 5]) for i in range(300)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(150)]  # a third are copies of one
    vectors += [(2000, None), (2001, [1.0] * 19 + [None]), (2002, [float("nan")] * 20), (2003, [float("inf")] + [0.0] * 19), (2004, []),
                (2005, [1.0, 2.0]), vectors[3]]
    got = whitening.whitened(table(spark, vectors)).collect()
    want, explained = plain([v for v in vectors if v[0] != 2005])
    assert len(got) == 16 * 451  # one repeated row
    rows = {}
    for r in got:
        rows.setdefault(r["vec_id"], {})[r["component"]] = r
        assert (r["n"], r["deviation"]) == want[r["vec_id"]][:2]
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9
    assert set(rows) == set(want)
    for k in range(16):
        a = np.array([rows[i][k + 1]["whitened"] for i in sorted(rows)])
        b = np.array([want[i][2][k] for i in sorted(rows)])
        assert np.allclose(a * np.sign(a @ b), b, atol=1e-8)


def test_odd_tables(spark):
    assert whitening.whitened(table(spark, [])).count() == 0
    assert whitening.whitened(table(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whitened(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    line = whitening.whitened(table(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])).collect()
    assert len(line) == 9 and {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12
    huge = whitening.whitened(table(spark, [(1, [3e38, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])])).collect()
    assert len(huge) >= 3 and all(np.isfinite(r["whitened"]) for r in huge)


def test_sums_are_exact(spark):
    rows = [(i, [1000.0 + i % 7, -2.0e6, i / 64.0]) for i in range(500)]
    vectors = whitening.integer_vectors(table(spark, rows)).select("x").distinct()
    n, sums = whitening._sums(vectors, 3)
    want = {tuple(int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v) for _, v in rows}
    assert n == len(want) and sums == [sum(c) for c in zip(*want)]


@pytest.mark.parametrize("case", ["random", "ties", "graded", "zero", "flat", "cluster", "rank"])
def test_divide_and_conquer(case):
    draw = np.random.default_rng(5)
    q = np.linalg.qr(draw.standard_normal((24, 24)))[0]
    x = draw.standard_normal((10, 24))
    v = {"random": np.cov(draw.standard_normal((90, 24)).T), "ties": (q * np.repeat([5.0, 2.0, 1.0, 0.0], 6)) @ q.T,
         "graded": (q * 10.0 ** -np.arange(24)) @ q.T, "zero": np.zeros((24, 24)), "flat": 3 * np.eye(24),
         "cluster": np.ones((24, 24)) + 1e-3 * np.eye(24), "rank": x.T @ x}[case]
    v = (v + v.T) / 2
    values, vectors = whitening.components(v)
    size = max(np.linalg.norm(v), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1]).max() <= 1e-14 * size
    assert np.abs(vectors.T @ vectors - np.eye(24)).max() < 1e-13
    assert np.linalg.norm(v @ vectors - vectors * values) <= 1e-13 * size


def test_polar_factor():
    draw = np.random.default_rng(6)
    a = draw.standard_normal((40, 40))
    a = a + a.T
    u = whitening.polar(a)
    w, x = np.linalg.eigh(a)
    assert np.abs(u - (x * np.sign(w)) @ x.T).max() < 1e-11

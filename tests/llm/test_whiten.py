from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import whiten


def faddeev(a):
    """Characteristic polynomial by the exact Faddeev-LeVerrier recurrence."""
    d = len(a)
    mul = lambda x, y: [[sum(x[i][k] * y[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
    m, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = mul(a, m)
        for i in range(d):
            m[i][i] += out[-1]
        out.append(-sum(mul(a, m)[i][i] for i in range(d)) / k)
    return [int(c) for c in out]


def gram(rows):
    d, n = len(rows[0]), len(rows)
    t = [sum(r[j] for r in rows) for j in range(d)]
    return n, t, [[n * sum(r[i] * r[j] for r in rows) - t[i] * t[j] for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("seed, d, size", [(1, 1, 9), (2, 2, 10**6), (3, 5, 10**4), (4, 9, 3), (5, 7, 10**12)])
def test_polynomial_and_roots(spark, seed, d, size):
    r = random.Random(seed)
    rows = [[r.randint(-size, size) for _ in range(d)] for _ in range(d + 1 - d // 8 * 4)]
    _, _, a = gram(rows)
    p = whiten.characteristic_polynomial(spark, a)
    assert p == faddeev(a)
    trace = sum(a[i][i] for i in range(d))
    roots, shift = whiten.largest_roots(p, trace, d)
    want = np.linalg.eigvalsh(np.array(a, float))[::-1]
    assert len(roots) == min(d, len(rows) - 1)  # exact rank
    assert np.allclose([x / 2**shift for x in roots], want[:len(roots)], rtol=1e-9, atol=1e-9 * want[0])


def test_equal_roots_span_their_space():
    a = [[4, 0, 0, 0], [0, 9, 0, 0], [0, 0, 4, 0], [0, 0, 0, 9]]
    roots, shift = whiten.largest_roots(faddeev(a), 26, 4)
    assert [x / 2**shift for x in roots] == [9, 9, 4, 4]
    v = np.array([[x / 2**whiten.WORK_BITS for x in u] for u in whiten.null_vectors(a, 26, roots, shift)])
    assert np.abs(v @ v.T - np.eye(4)).max() < 1e-15 and np.abs(v[:2, [0, 2]]).max() < 1e-15


def brute(rows, components=8):
    """(id, component) -> exact n, deviation, and eigen-decomposition in doubles."""
    fit = [(i, [math.floor(1024 * c) + 100000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in fit], float)
    n, s = len(fit), [sum(v[j] for _, v in fit) for j in range(x.shape[1])]
    z = x - x.mean(axis=0)
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1], u[:, ::-1]
    return [(i, sum((n * a - b) ** 2 for a, b in zip(v, s))) for i, v in fit], z @ u[:, :components] / np.sqrt(e[:components]), e / e.sum()


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 3, 4.0) for i, v in rows], f"vec_id long, embedding array<{kind}>, n int, whitened double")


@pytest.mark.parametrize("seed, n, d, scale", [(1, 300, 12, 1.0), (2, 120, 3, 40.0), (3, 60, 8, 3e6)])
def test_against_numpy(spark, seed, n, d, scale):
    r = np.random.default_rng(seed)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate((r.normal(size=(n, d)) * np.linspace(1, 3, d) * scale).astype(np.float32))]
    rows += [(n, rows[0][1]), (n, rows[0][1]), (None, rows[1][1])]
    broken = [(n + 1, None), (n + 2, [1.0] * (d - 1) + [None]), (n + 3, [float("nan")] * d), (n + 4, [float("inf")] + [0.0] * (d - 1)), (n + 5, []), (n + 6, [1.0])]
    got = whiten.whiten(frame(spark, rows + broken)).collect()
    want, w, share = brute(rows)
    k = min(8, d)
    assert len(got) == len(rows) * k and {x.n for x in got} == {len(rows)}
    by = {}
    for x in got:
        by.setdefault(x.component, []).append(x)
    for c, xs in by.items():
        assert sorted((x.vec_id is None, x.vec_id or 0, int(x.deviation)) for x in xs) == sorted((i is None, i or 0, dev) for i, dev in want)
        assert abs(xs[0].explained - share[c - 1]) < 1e-9
        key = lambda p: (p[0] is None, p[0] or 0, p[1])
        a = np.array([v for *_, v in sorted(((x.vec_id, int(x.deviation), x.whitened) for x in xs), key=key)])
        b = np.array([v for *_, v in sorted(((i, dev, y) for (i, dev), y in zip(want, w[:, c - 1])), key=key)])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
    assert {x.identity_error for x in got}.pop() < 1e-9


def test_nothing_to_whiten(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whiten.whiten(frame(spark, rows))
        assert got.columns == columns and got.collect() == []


def test_huge_entries_saturate(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])]
    got = whiten.whiten(frame(spark, rows, "double"), components=1).collect()
    y = [[2**53, 0], [-2**53, 1024], [0, 2048]]
    n, t, _ = gram(y)
    assert sorted((r.vec_id, int(r.deviation)) for r in got) == [(i + 1, sum((n * a - b) ** 2 for a, b in zip(v, t))) for i, v in enumerate(y)]
    assert got[0].identity_error < 1e-9

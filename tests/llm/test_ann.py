from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerline.llm import ann


def exact(rows, k, asked):
    out = {}
    for q, v in rows:
        if asked(q):
            near = sorted((-float((np.array(v) * np.array(x)).sum()), i) for i, x in rows if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def test_chi_square():
    assert abs(ann.chi2_cdf(ann.chi2_quantile(0.95, 8), 8) - 0.95) < 1e-9
    assert abs(ann.chi2_quantile(0.95, 8) - 15.507) < 1e-3 and abs(ann.chi2_quantile(0.9, 2) - 4.605) < 1e-3


@pytest.mark.parametrize("shape", ["random", "clusters", "hot vector", "axes"])
def test_recall_scores_and_order(spark, shape):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16))
    if shape == "clusters":
        x = rng.normal(size=(30, 16))[rng.integers(0, 30, 1500)] * 3 + rng.normal(size=(1500, 16)) * 0.2
    if shape == "hot vector":
        x[rng.random(1500) < 0.4] = x[0]
    if shape == "axes":
        x = np.eye(16)[rng.integers(0, 16, 1500)]
    rows = [(int(i), [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    got = {}
    for r in ann.nearest(df, lambda i: i % 20 == 0, cell_rows=200).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = exact(rows, 20, lambda i: i % 20 == 0)
    assert set(got) == set(want)
    hits = 0
    for q, near in got.items():
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, 21))
        assert [(-s, i) for _, i, s in near] == sorted((-s, i) for _, i, s in near)
        assert all(math.isclose(s, np.dot(rows[q][1], rows[i][1]), rel_tol=1e-12, abs_tol=1e-12) for _, i, s in near)
        hits += len({i for _, i, _ in near} & {i for i, _ in want[q]})
    assert hits >= 0.95 * 20 * len(want)
    if shape in ("hot vector", "axes"):  # ties only; all must be there
        assert hits == 20 * len(want)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]),
            (None, [1.0, 1.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (40, []), (60, [-1.0, 0.5])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, qid int, v int")
    got = sorted(map(tuple, ann.nearest(df, lambda i: i % 20 == 0).collect()))
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 1.0), (0, 3, 60, 0.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 60, -1.0),
                   (60, 1, 0, 0.0), (60, 2, 1, -1.0), (60, 3, 20, -1.0)]
    assert ann.nearest(df.limit(0), lambda i: i % 20 == 0).collect() == []


@pytest.mark.parametrize("scale", [1.0, 1e-6, 1e4])
def test_many_scores_within_the_tolerance(scale):
    """Scores are compared as they are, however short the vectors and however many lie close together."""
    rng = np.random.default_rng(6)
    vectors = (rng.standard_normal((1_500, 8)) if scale < 1 else 1 + 1e-11 * rng.standard_normal((1_500, 8))) * scale
    longest = float((vectors ** 2).sum(axis=1).max())
    cell = ann.Cell(vectors, [[i] for i in range(len(vectors))], rng.standard_normal((9, ann.PROJECTIONS)), longest)
    q = vectors[700]
    exact = (vectors * q).sum(axis=1)
    want = sorted((-s, i) for i, s in enumerate(exact.tolist()))[:21]
    assert cell.search(q, 21, 1e9, -1.0)[0] == [(-s, i) for s, i in want]

from __future__ import annotations

import numpy as np

from ledgerline.llm import sharding


def test_hypergeometric_matches_its_moments():
    rng = np.random.default_rng(1)
    for good, bad, n in ((5, 7, 6), (300, 1700, 120), (3_000_000_000, 9_000_000_000, 5_000_000)):
        got = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(3000)], dtype=float)
        p, total = good / (good + bad), good + bad
        sd = (n * p * (1 - p) * (total - n) / (total - 1)) ** 0.5
        assert abs(got.mean() - n * p) < 5 * sd / 3000 ** 0.5
        assert abs(got.std() / sd - 1) < 0.08
    assert [sharding.hypergeometric(rng, *x) for x in ((0, 5, 3), (5, 0, 3), (4, 4, 8), (4, 4, 0))] == [0, 3, 4, 0]


def test_matrix_sums():
    sizes, room = [0, 7, 100, 3], [28, 28, 27, 27]
    m = sharding.communication_matrix(np.random.default_rng(2), sizes, room)
    assert m.sum(axis=1).tolist() == sizes and m.sum(axis=0).tolist() == room


def test_every_row_once_in_gapless_slots(spark, docs_of, monkeypatch):
    monkeypatch.setattr(sharding, "COPY_BLOCK", 8)
    rows = [(i, f"text {i}") for i in range(300)] + [(7, "hot")] * 150 + [(None, None), (None, None), (9, ""), (9, None)]
    got = sharding.shard_rows(docs_of(rows), n_shards=16).collect()
    sizes = {s: sorted(r.slot for r in got if r.shard == s) for s in range(16)}
    assert all(v == list(range(len(v))) for v in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), len(t or "") + 1) for i, t in rows)
    hot = [r.shard for r in got if r.doc_id == 7 and r.size == 4]
    assert len(hot) == 150 and max(map(hot.count, range(16))) < 30
    again = sharding.shard_rows(docs_of(rows).repartition(3), n_shards=16).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_empty_table(spark, docs_of):
    assert sharding.shard_rows(docs_of([])).collect() == []

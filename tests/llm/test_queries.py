from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_held_out_languages(spark):
    got = QUERIES["op7_language_id"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    both = got.merge(docs, on="doc_id")
    held = both[both.held_out]
    assert len(got) == len(docs) and len(held) > 30 and (held.lang_pred == held.lang).mean() > 0.97


def test_native_queries_have_no_python_in_their_plans(spark):
    for name in ("op5_license_scan", "op8_hypergeometric_shards", "op13_line_dedup"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_recall_of_the_neighbour_search(spark):
    import numpy as np
    got = QUERIES["op10_nearest"](spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float)
    hits = 0
    for q, near in got.groupby("query_id"):
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        hits += len(set(near.vec_id) & set(ids[np.lexsort((ids, -score))[:20]]))
    assert hits >= 0.95 * len(got) and len(got) == 20 * (ids % 20 == 0).sum()


def test_whitening_of_the_whole_table(spark):
    import numpy as np
    from tests.llm.test_whiten import brute
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    want, w, share = brute([(i, [float(c) for c in v]) for i, v in zip(rows.vec_id, rows.embedding)])
    got = QUERIES["op11_whitening"](spark, SF).toPandas().sort_values(["component", "vec_id"])
    assert len(got) == 8 * len(rows) and got.identity_error.max() < 1e-9
    for c, x in got.groupby("component"):
        assert list(zip(x.vec_id, x.deviation)) == want and np.allclose(x.explained, share[c - 1], rtol=1e-9)
        assert min(np.abs(x.whitened - w[:, c - 1]).max(), np.abs(x.whitened + w[:, c - 1]).max()) < 1e-6

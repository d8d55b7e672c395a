"""A hot order holding a third of all item rows (many duplicated keys), checked by brute force."""

from __future__ import annotations

from decimal import Decimal

import pytest

from ledgerline.plans import build


def test_hot_order_fact_matches_brute_force(make_raw):
    orders = [{"order_id": f"o{i}", "customer_id": "c", "order_purchase_timestamp": "2017-01-01 00:00:00"}
              for i in range(60)]
    items = []
    for line in range(700):  # the hot order: 700 lines, each line three times with different prices
        for copy in range(3):
            items.append({"order_id": "o0", "order_item_id": str(line), "product_id": f"p{line % 37}",
                          "price": f"{line}.{copy}0"})
    for i in range(1, 60):
        for line in range(70):
            items.append({"order_id": f"o{i}", "order_item_id": str(line), "product_id": f"p{line % 5}",
                          "price": "1.00"})
    assert sum(r["order_id"] == "o0" for r in items) * 3 >= len(items)

    # Brute force: keep-last = greatest remaining raw columns per (order, line); here the highest price text.
    expected = {}
    best = {}
    for r in items:
        k = (r["order_id"], int(r["order_item_id"]))
        cand = (r["product_id"], r["price"])
        if k not in best or cand > best[k]:
            best[k] = cand
    for (oid, _), (pid, price) in best.items():
        e = expected.setdefault(oid, {"n": 0, "products": set(), "total": Decimal(0)})
        e["n"] += 1
        e["products"].add(pid)
        e["total"] += Decimal(price)

    facts = {r.order_id: r for r in build.full_fact_orders(make_raw(orders=orders, items=items)).collect()}
    assert len(facts) == 60
    for oid, e in expected.items():
        f = facts[oid]
        assert (f.order_item_count, f.distinct_product_count, f.total_item_value) == \
            (e["n"], len(e["products"]), e["total"].quantize(Decimal("0.01")))


@pytest.mark.parametrize("broadcast_rows", [50_000, 10])
def test_hot_order_through_loop_and_backlog(spark, make_raw, monkeypatch, broadcast_rows):
    """One order holds over a third of all items; a batch of few orders still has many items to upsert."""
    from ledgerline.session import scratch_path
    from ledgerline.streaming import batches
    from ledgerline.streaming.backlog import run_backlog
    from ledgerline.streaming.pipeline import run_pipeline
    from ledgerline.streaming.publish import Warehouse
    monkeypatch.setattr(batches, "BROADCAST_ROWS", broadcast_rows)
    orders = [{"order_id": f"o{i}", "customer_id": "c", "order_purchase_timestamp": f"2017-01-01 00:00:{i:02d}"} for i in range(9)]
    orders.append(dict(orders[0], order_purchase_timestamp="2017-03-01 00:00:00"))  # the hot order comes again, in another period
    items = [{"order_id": "o0", "order_item_id": str(n), "product_id": f"p{n % 7}", "price": "1.50"} for n in range(600)]
    items += [{"order_id": f"o{i}", "order_item_id": str(n), "price": "2"} for i in range(1, 9) for n in range(100)]
    raw = make_raw(orders=orders, items=items)
    loop, backlog = (Warehouse(spark, scratch_path(spark, n)) for n in ("loop", "backlog"))
    assert run_pipeline(spark, raw, loop, batch_size=4) == run_backlog(spark, raw, backlog, batch_size=4) == 3
    for store in (loop, backlog):
        facts = {r.order_id: r for r in store.read("fact_orders").collect()}
        assert (facts["o0"].order_item_count, facts["o0"].distinct_product_count, facts["o0"].total_item_value) == (600, 7, Decimal("900.00"))
        assert facts["o0"].source_batch_id == 3 and all(facts[f"o{i}"].total_item_value == 200 for i in range(1, 9))
        assert store.read("fact_order_items").count() == 1400


def test_uncounted_or_large_key_sets_are_not_broadcast(spark, make_raw, monkeypatch):
    from ledgerline.session import scratch_path
    from ledgerline.streaming import batches
    from ledgerline.streaming.publish import Warehouse
    raw = make_raw(orders=[{"order_id": f"o{i}", "customer_id": "c", "order_purchase_timestamp": "2017-01-01 00:00:00"} for i in range(20)],
                   items=[{"order_id": f"o{i % 20}", "order_item_id": str(i)} for i in range(300)])
    batch = batches.keyset_batch(raw["raw_orders"], "1900-01-01 00:00:00", "", 100).checkpoint()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, tables in ((100, {"stg_orders"}), (10, set())):
            monkeypatch.setattr(batches, "BROADCAST_ROWS", limit)
            result = batches.process_batch(raw, batch, 20, 1, Warehouse(spark, scratch_path(spark, "plans")))
            plans = {t: result.planned[t].df._jdf.queryExecution().optimizedPlan().toString() for t in ("stg_orders", "stg_order_items")}
            assert {t for t, p in plans.items() if "strategy=broadcast" in p} == tables
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_null_keys_are_spread_and_join_as_one_key(spark):
    """Half of all keys are NULL: same rows as a plain null-safe join, and no task has three times the median."""
    from collections import Counter
    from statistics import median

    from pyspark.sql import functions as F

    from ledgerline.operators.nullsafe import left_join_null_safe
    left = spark.range(8000).select(F.when(F.col("id") % 2 == 0, F.concat(F.lit("k"), F.col("id") % 900)).alias("k"), (F.col("id") % 50).alias("v"))
    right = spark.createDataFrame([(f"k{i}", f"s{i % 7}") for i in range(0, 800, 3)] + [(None, "none"), (None, "again"), ("k0", "twice")], "rk string, s string")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = left_join_null_safe(left, right, "k", "rk")
        assert got.columns == ["k", "v", "s"]
        want = left.join(right, left["k"].eqNullSafe(right["rk"]), "left").drop("rk")
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 3 * median(sizes)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

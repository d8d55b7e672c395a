"""What cleaning and a backlog load cost in plans, with the same rows."""

from __future__ import annotations

from ledgerline.functions.text import WHITESPACE, strip_unicode
from ledgerline.plans import build, registry
from ledgerline.session import scratch_path
from ledgerline.streaming import backlog
from ledgerline.streaming.publish import Warehouse

from .test_pipeline import assert_equal_stores, o, run_both


def test_visible_text_is_not_searched_for_white_space(spark):
    """The trim stands behind a comparison of both ends."""
    inner = ["a", "a b", "é", "~", "!", "\x7f", "​", "b　c", ""]
    values = [a + x + b for x in inner for a in ("", *WHITESPACE) for b in ("", *WHITESPACE)]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r.y for r in df.select(strip_unicode("x").alias("y")).collect()]
    assert got == [v.strip() for v in values]
    assert "CASE WHEN" in df.select(strip_unicode("x"))._jdf.queryExecution().optimizedPlan().toString().upper().split("TRIM(")[0]


def test_children_of_several_spellings_with_other_values(spark, make_raw):
    """Staging takes the last batch's row, the fact what the order's final batch fetched, also after one cleaning for both."""
    orders = [o("k", "2020-01-01 00:00:00"), o(" k", "2020-02-02 00:00:00"), o("m", "2020-02-03 00:00:00"), o("k ", "2020-03-04 00:00:00"), o("k", "2020-03-05 00:00:00")]
    named = [(i, str(n), p) for i in ("k", " k", "k ", "m") for n in (1, 2) for p in ("3", "1", "2")] + [(" k", "7", "9"), ("k ", "8", "4")]
    raw = make_raw(
        orders=orders, items=[{"order_id": i, "order_item_id": n, "product_id": f"p{p}", "price": f"{p}.5"} for i, n, p in named],
        payments=[{"order_id": i, "payment_sequential": n, "payment_value": p} for i, n, p in named],
        reviews=[{"order_id": i, "review_id": f"{n} ", "review_score": p} for i, n, p in named])
    (loop, e1), (over, e2) = run_both(spark, raw, 2)
    assert e1 is None and e2 is None
    assert_equal_stores(loop, over)


def test_rows_are_cleaned_once_and_ranges_sample_files(spark, make_raw, monkeypatch):
    """What is published is read from staged files, without joins; nothing is cleaned again there."""
    seen = {}
    monkeypatch.setattr(backlog, "publish_planned", lambda store, planned, extra, sort_by=None: seen.update({t: p.df for t, p in planned.items()}))
    raw = make_raw(orders=[o(f"o{i}", f"2020-01-0{i + 1} 00:00:00") for i in range(4)], items=[{"order_id": f"o{i}", "order_item_id": "1", "price": "2"} for i in range(4)])
    backlog.run_backlog(spark, raw, Warehouse(spark, scratch_path(spark, "cost")), batch_size=2)
    for table in ("stg_orders", "fact_orders", "stg_order_items", "fact_order_items", "stg_payments", "stg_reviews", "dim_customer", "dim_product", "dim_seller"):
        plan = seen[table]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "RLIKE" not in plan.upper() and "InMemoryRelation" not in plan, table


def test_fact_children_are_moved_once(spark, make_raw, monkeypatch):
    """a child row is dealt by its cleaned order id for the match with the orders, the dedupe and the sums."""
    raw = make_raw(orders=[o("k", "2020-01-01 00:00:00")], items=[{"order_id": "k", "order_item_id": "1", "price": "2"}])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = build.full_fact_orders(raw)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange") == 7  # the orders, three kinds of children, and for each the ids of the orders
    assert "invalid timestamp" not in plan  # the orders were judged and written before


def test_fact_takes_children_by_raw_id(spark, make_raw):
    """rows under a spelling that no eligible order has stay out; those under an order that is dropped later count."""
    orders = [o("k", "2020-01-01 00:00:00"), o("k\t", "2020-01-02 00:00:00"), {**o(" k", "2020-01-03 00:00:00"), "order_purchase_timestamp": None},
              o("m", "2020-01-04 00:00:00"), {**o(" m", "2020-01-05 00:00:00"), "customer_id": None}, o(" ", "2020-01-06 00:00:00")]
    spelled = [("k", "1"), (" k", "2"), ("k ", "4"), ("k\t", "8"), ("m", "16"), (" m", "32"), (" ", "64"), (None, "128"), ("m", "16")]
    raw = make_raw(orders=orders, items=[{"order_id": i, "order_item_id": p, "price": p} for i, p in spelled],
                   payments=[{"order_id": i, "payment_sequential": p, "payment_value": p} for i, p in spelled],
                   reviews=[{"order_id": i, "review_id": p, "review_score": "1"} for i, p in spelled])
    facts = {r.order_id: (r.order_item_count, r.total_item_value, r.total_payment_value, r.review_count) for r in build.full_fact_orders(raw).collect()}
    assert facts == {"k": (2, 9, 9, 2), "m": (2, 48, 48, 2)}


def test_clustered_write_samples_files(spark, monkeypatch):
    """what the range partitioning samples is read from files, without joins."""
    frame, seen = type(spark.range(1)), []
    ranged = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, *keys: seen.append(self._jdf.queryExecution().optimizedPlan().toString()) or ranged(self, *keys))
    got = registry.QUERIES["clustered_write"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 1 and "Join" not in seen[0] and "Window" not in seen[0]
    assert got.exceptAll(registry.QUERIES["fact_orders"](spark, "/root/testdata/sf0.001")).count() == 0 and got.count()

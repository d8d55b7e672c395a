"""Cleaners, fact and serving table on hand-made rows (rules R1-R4, R6, R11, R13, R20, R23)."""

from __future__ import annotations

import pytest

from decimal import Decimal

from ledgerline.plans import build, entities as E, serving

TS = "2017-10-02 10:56:33"


def order(oid, cust="c1", ts=TS, **kw):
    return {"order_id": oid, "customer_id": cust, "order_status": " Delivered ", "order_purchase_timestamp": ts,
            "order_delivered_customer_date": kw.get("delivered")}


def item(oid, n, price, pid="p1", freight="1"):
    return {"order_id": oid, "order_item_id": n, "product_id": pid, "seller_id": "s1", "price": price,
            "freight_value": freight}


def facts_by_id(raw):
    return {r.order_id: r for r in build.full_fact_orders(raw).collect()}


def test_r1_all_null_sum_is_zero_absent_is_null(make_raw):
    raw = make_raw(orders=[order("o1"), order("o2")], items=[item("o1", "1", "")])
    f = facts_by_id(raw)
    assert f["o1"].total_item_value == Decimal("0.00") and f["o1"].order_item_count == 1
    assert f["o2"].total_item_value is None and f["o2"].order_item_count == 0
    assert f["o2"].distinct_product_count == 0 and f["o2"].review_count == 0


def test_r2_mean_of_nulls(make_raw):
    raw = make_raw(orders=[order("o1")], reviews=[{"review_id": "r1", "order_id": "o1"},
                                                  {"review_id": "r2", "order_id": "o1"}])
    f = facts_by_id(raw)["o1"]
    assert f.avg_review_score is None and f.review_count == 0


def test_r3_serving_null_safe_join(make_raw):
    raw = make_raw(orders=[order("o1")], items=[{"order_id": "o1", "order_item_id": "1", "product_id": None}],
                   products=[{"product_id": None, "product_category_name": "x"}])
    r = serving.build_orders_serving(raw).first()
    assert r.product_categories == "x" and r.items_count == 1


def test_r4_null_key_in_no_group(make_raw):
    raw = make_raw(orders=[order("o1")], items=[item(None, "1", "5"), item("o1", "1", "2")])
    f = facts_by_id(raw)["o1"]
    assert f.total_item_value == Decimal("2.00") and f.order_item_count == 1


def test_r6_money_summed_before_rounding(make_raw):
    raw = make_raw(orders=[order("o1")], items=[item("o1", "1", "0.004"), item("o1", "2", "0.004")])
    f = facts_by_id(raw)["o1"]
    assert f.total_item_value == Decimal("0.01")
    c = build.full_clean(raw)
    from ledgerline import schemas
    from ledgerline.plans.store import typed
    assert sorted(r.price for r in typed(c.items, schemas.ORDER_ITEMS).collect()) == [Decimal("0.00")] * 2


def test_r11_clean_then_dedupe_collapses_whitespace_keys(make_raw, spark):
    raw = make_raw(customers=[{"customer_id": "c1", "customer_city": "A"},
                              {"customer_id": " c1 ", "customer_city": "B"}])
    rows = E.clean_customers(raw["raw_customers"]).collect()
    assert len(rows) == 1 and rows[0].customer_id == "c1"


def test_r13_duplicate_order_ids_one_fact_row(make_raw):
    raw = make_raw(orders=[order("o1", ts="2017-10-02 10:00:00"), order("o1", cust="c2", ts="2017-10-03 10:00:00")])
    rows = build.full_fact_orders(raw).collect()
    assert len(rows) == 1 and rows[0].customer_id == "c2"
    assert build.full_clean(raw).orders.count() == 2


def test_r20_r23_serving_categories_and_counts(make_raw):
    raw = make_raw(orders=[order("o1"), order("o2"), order("o3")],
                   items=[item("o1", "1", "1", pid="p1"), item("o3", "1", "1", pid="p2"), item("o3", "2", "1", pid="p3")],
                   products=[{"product_id": "p1", "product_category_name": None},
                             {"product_id": "p2", "product_category_name": "toys"},
                             {"product_id": "p3", "product_category_name": "books"}])
    s = {r.order_id: r for r in serving.build_orders_serving(raw).collect()}
    assert s["o1"].product_categories is None and s["o1"].items_count == 1
    assert s["o2"].items_count is None
    assert s["o3"].product_categories == "books, toys"


def test_products_translation_fanout_dedupes(make_raw):
    raw = make_raw(products=[{"product_id": "p1", "product_category_name": "a", "product_weight_g": "40.0"}],
                   translations=[{"product_category_name": "a", "product_category_name_english": "X"},
                                 {"product_category_name": "a", "product_category_name_english": "Y"}])
    rows = E.clean_products(raw["raw_products"], raw["raw_translations"]).collect()
    assert len(rows) == 1 and rows[0].product_category_name_english == "y" and rows[0].product_weight_g == 40


def test_r17_closure_on_raw_keys_fact_on_cleaned(make_raw):
    """Items are fetched by the raw order id; the fact joins them on the cleaned id."""
    raw = make_raw(orders=[order(" o1")],
                   items=[item(" o1", "1", "5"), item("o1", "2", "7")])
    f = facts_by_id(raw)
    assert set(f) == {"o1"}
    assert f["o1"].order_item_count == 1 and f["o1"].total_item_value == Decimal("5.00")


def test_r12_ordinal_decides_last(spark):
    from ledgerline.operators.keys import TIEBREAK, dedupe_keep_last, tiebreak_of
    raw = spark.createDataFrame([("c1", "z", 0), ("c1", "a", 1)], "customer_id string, city string, _ordinal long")
    df = raw.select("customer_id", "city", tiebreak_of(raw, ["customer_id"]).alias(TIEBREAK))
    assert dedupe_keep_last(df, ["customer_id"]).first().city == "a"  # last read, not greatest
    no_ord = raw.drop("_ordinal")
    df2 = no_ord.select("customer_id", "city", tiebreak_of(no_ord, ["customer_id"]).alias(TIEBREAK))
    assert dedupe_keep_last(df2, ["customer_id"]).first().city == "z"  # greatest raw columns


def test_r24_empty_upsert_is_a_noop(spark):
    from ledgerline.operators.upsert import upsert
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    empty = spark.createDataFrame([], "k string, v int")
    for bounded in (False, True):
        assert [tuple(r) for r in upsert(t, empty, ["k"], new_bounded=bounded).collect()] == [("a", 1)]


def test_r22_bronze_keeps_source_text(spark, tmp_path):
    from ledgerline.sources import ingest
    (tmp_path / "t.csv").write_text("zip,price\n01409,58.90\n", encoding="utf-8")
    row = ingest.load_csv_directory(spark, str(tmp_path))["t"].first()
    assert (row.zip, row.price) == ("01409", "58.90")


@pytest.mark.parametrize("parts", [1, 3, 7])
@pytest.mark.parametrize("join", ["broadcast", "merge"])
def test_last_translation_in_the_file_wins_with_any_plan(spark, tmp_path, parts, join):
    """Twenty translations per category: the last merged row is the last product row's last translation."""
    from ledgerline.sources import ingest
    (tmp_path / "p.csv").write_text("product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
                                    "product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
                                    + "".join(f"p{i % 50},cat{i % 4},1,1,1,{i},1,1,1\n" for i in range(100)), encoding="utf-8")
    (tmp_path / "t.csv").write_text("product_category_name,product_category_name_english\n"
                                    + "".join(f"cat{i % 4},name_{(i * 37) % 80:02d}\n" for i in range(80)), encoding="utf-8")
    tables = ingest.load_csv_directory(spark, str(tmp_path))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if join == "merge" else threshold)
    try:
        got = {r.product_id: (r.product_weight_g, r.product_category_name_english)
               for r in E.clean_products(tables["p"].repartition(parts), tables["t"].repartition(parts)).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    want = {}
    for i in range(100):  # file order: later rows replace earlier ones
        want[f"p{i % 50}"] = (i, f"name_{((76 + i % 4) * 37) % 80:02d}")
    assert got == want

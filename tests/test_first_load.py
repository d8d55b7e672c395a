"""What a first load and the batch order cost in plans, with the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators.upsert import first_rows, upsert
from ledgerline.plans.build import eligible_orders
from ledgerline.streaming.batches import keyset_batch

WHEN = dt.datetime(2020, 1, 1)


def test_first_rows_are_what_an_upsert_into_an_empty_table_gives(spark):
    target = spark.createDataFrame([], "k string, v int, kept string, loaded_at timestamp_ntz")
    new = spark.createDataFrame([("a", 1), (None, 2)], "k string, v long")
    now = F.lit(WHEN)
    first = first_rows(target, new, audit="loaded_at", now=now)
    assert first.schema.simpleString() == target.schema.simpleString()
    rows = sorted(map(str, first.collect()))
    assert rows == sorted(map(str, upsert(target, new, ["k"], audit="loaded_at", now=now).collect()))
    assert "Join" not in first._jdf.queryExecution().optimizedPlan().toString()


def test_the_batch_order_compares_parsed_times(spark, make_raw):
    raw = make_raw(orders=[{"order_id": i, "order_purchase_timestamp": t} for i, t in
                           [("b", "2017-01-02"), (None, "2017-01-02"), ("a", "2017-01-02 00:00:00"), ("c", "2017-01-01"), ("d", None), ("a", "2017-01-03")]])["raw_orders"]
    batch = keyset_batch(raw, "1900-01-01 00:00:00", "", 10)
    assert [r.order_id for r in batch.collect()] == ["c", "a", "b", None, "a"] and batch.columns == raw.columns
    plan = batch._jdf.queryExecution().optimizedPlan().toString()
    order = next(line for line in plan.splitlines() if "Sort [" in line)
    assert "raise_error" not in order.lower() and "rlike" not in order.lower()
    after = eligible_orders(raw, "2017-01-02 00:00:00", "a").select("order_id").collect()
    assert sorted(r.order_id for r in after) == ["a", "b"]  # no id at the watermark's time: behind it for good

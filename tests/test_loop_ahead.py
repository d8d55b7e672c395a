"""The loop cleans a batch while the one before is published."""

from __future__ import annotations

import pytest

from ledgerline.functions import clean_text, to_integer
from ledgerline.streaming import pipeline
from ledgerline.streaming.pipeline import run_pipeline
from ledgerline.streaming.publish import Warehouse

from .test_pipeline import o


def _raw(make_raw, bad: str = "1"):
    rows = [o(f"o{i}", f"2017-01-0{i} 00:00:00") for i in (1, 2, 3)]
    return make_raw(orders=rows, items=[{"order_id": f"o{i}", "order_item_id": bad if i == 2 else "1", "product_id": "p"} for i in (1, 2, 3)])


def test_the_next_batch_is_cleaned_before_this_one_is_visible(spark, make_raw, store_root, monkeypatch):
    done, plan = [], pipeline.process_batch

    def process(raw, batch, n, batch_id, store, closure=None, new=None):
        done.append((batch_id, new is not None))
        return plan(raw, batch, n, batch_id, store, closure, new)

    started = []

    def ahead(*args, clean=pipeline._rows_ahead):
        started.append(args[-1])
        return clean(*args)

    monkeypatch.setattr(pipeline, "process_batch", process)
    monkeypatch.setattr(pipeline, "_rows_ahead", ahead)
    assert run_pipeline(spark, _raw(make_raw), Warehouse(spark, store_root), batch_size=1, max_batches=2) == 2
    assert done == [(1, True), (2, True)] and started == [2]  # nothing beyond the batches asked for


def test_an_error_ahead_is_that_batchs_own(spark, make_raw, store_root):
    store = Warehouse(spark, store_root)
    with pytest.raises(Exception, match="fractional order_item_id"):
        run_pipeline(spark, _raw(make_raw, "1.5"), store, batch_size=1)
    log = store.read("etl_batch_log").select("batch_id", "status").orderBy("batch_id").collect()
    assert [tuple(r) for r in log] == [(1, "completed"), (2, "failed")]
    assert [r.order_id for r in store.read("fact_orders").collect()] == ["o1"]
    assert run_pipeline(spark, _raw(make_raw), store, batch_size=1) == 2
    ids = {r.order_id: r.source_batch_id for r in store.read("fact_orders").collect()}
    assert ids == {"o1": 1, "o2": 3, "o3": 4}


def test_an_expression_of_a_name_is_made_once(spark):
    assert clean_text("a", "lower") is clean_text("a", "lower") and clean_text("a", "lower") is not clean_text("a", "upper")
    assert to_integer("a", what="x") is not to_integer("a", what="y")

"""What a backlog load holds on disk: frames go behind their last reader, shuffle files behind their frame."""

from __future__ import annotations

import glob
import os

from ledgerline.session import checkpoint_root, scratch_path
from ledgerline.streaming import backlog, batches, publish
from ledgerline.streaming.publish import Warehouse

from .test_pipeline import o


def staged_frames(spark) -> set[str]:
    root = checkpoint_root(spark).removeprefix("file://").removeprefix("file:")
    return {os.path.basename(p) for p in glob.glob(f"{root}/batch-*/*")}


def test_a_backlog_load_drops_what_is_read(spark, make_raw, monkeypatch):
    """Rows in between are gone before the tables are written, a staged frame with the last table made of it, and none is left."""
    before, seen, checks, drops = staged_frames(spark), {}, Warehouse._repeated_keys, []
    monkeypatch.setattr(backlog, "SIDE_BY_SIDE", 3)
    for module in (batches, publish):
        monkeypatch.setattr(module, "drop_unused_shuffles", lambda spark, drop=module.drop_unused_shuffles: drops.append(1) or drop(spark))
    monkeypatch.setattr(Warehouse, "_repeated_keys", lambda self, table, written: seen.update({table: staged_frames(spark) - before}) or checks(self, table, written))
    raw = make_raw(orders=[o(f"o{i}", f"2020-01-0{i + 1} 00:00:00") for i in range(4)],
                   items=[{"order_id": f"o{i}", "order_item_id": "1", "product_id": "p", "price": "2"} for i in range(4)],
                   payments=[{"order_id": "o1", "payment_sequential": "1", "payment_value": "2"}], reviews=[{"order_id": "o2", "review_id": "r", "review_score": "3"}])
    store = Warehouse(spark, scratch_path(spark, "disk"))
    assert backlog.run_backlog(spark, raw, store, batch_size=2) == 2
    large = [t for t in seen if t in publish.PARTITIONED]
    assert large[-2:] == ["fact_order_items", "stg_order_items"] and len(large) == 7
    assert "orders" in seen["stg_orders"] and not {"orders", "payments", "reviews", "pairs", "fact_orders"} & seen["fact_order_items"]
    assert not {"eligible", "ranked", "assigned", "scanned", "order_maxb", "named", "item_measures"} & set().union(*seen.values())
    assert staged_frames(spark) == before
    assert len(drops) >= 15 + 2 * 7  # behind every staged frame, and behind the writing and the checking of every large table
    assert {r.order_id: r.order_item_count for r in store.read("fact_orders").collect()} == {f"o{i}": 1 for i in range(4)}


def test_a_failing_load_leaves_no_frames(spark, make_raw):
    """Also where a cell refuses to be read."""
    before = staged_frames(spark)
    raw = make_raw(orders=[o("a", "2020-01-01 00:00:00")], items=[{"order_id": "a", "order_item_id": "1.5"}])
    store = Warehouse(spark, scratch_path(spark, "disk"))
    try:
        backlog.run_backlog(spark, raw, store, batch_size=2)
    except Exception as exc:
        assert "fractional order_item_id" in str(exc)
    assert [r.status for r in store.read("etl_batch_log").collect()] == ["failed"]
    assert staged_frames(spark) == before

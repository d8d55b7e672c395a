"""The three command-line jobs end to end on the smallest test tables."""

from __future__ import annotations

import pytest

from ledgerline import cli
from ledgerline.plans.publishing import ConstraintViolation
from ledgerline.session import scratch_path
from ledgerline.sources import ingest
from ledgerline.sources.binding import bind_raw
from ledgerline.streaming.publish import Warehouse


def test_ingest_load_serve(spark):
    raw = bind_raw(spark, "/root/testdata/sf0.001")
    csv_dir, bronze, wh = (scratch_path(spark, n) for n in ("cli-csv", "cli-bronze", "cli-wh"))
    ingest.write_csv_tables({k.removeprefix("raw_"): v for k, v in raw.items()}, csv_dir)
    assert cli.main(["ingest", "--csv-dir", csv_dir, "--bronze", bronze]) == 0
    assert ingest.read_bronze(spark, bronze)["raw_orders"].count() == raw["raw_orders"].count()
    assert cli.main(["load", "--bronze", bronze, "--warehouse", wh, "--batch-size", "500",
                     "--max-batches", "1", "--full-refresh", "false"]) == 0
    assert cli.main(["load", "--bronze", bronze, "--warehouse", wh, "--batch-size", "500", "--backlog"]) == 0
    store = Warehouse(spark, wh)
    assert [r.batch_id for r in store.read("etl_batch_log").orderBy("batch_id").collect()] == [1, 2, 3]
    # The serving table has orders without a customer id: it is refused, nothing published.
    with pytest.raises(ConstraintViolation, match="not_null:customer_id"):
        cli.main(["serve", "--bronze", bronze, "--warehouse", wh])
    assert Warehouse(spark, wh).read("orders").count() == 0
    with pytest.raises(SystemExit):
        cli.main(["load", "--bronze", bronze, "--warehouse", wh, "--full-refresh", "maybe"])


def test_serving_table_published_when_clean(spark, make_raw, store_root):
    from ledgerline.plans.publishing import publish_orders_serving
    raw = make_raw(orders=[{"order_id": "o1", "customer_id": "c1", "order_purchase_timestamp": "2017-01-01 00:00:00"}],
                   items=[{"order_id": "o1", "order_item_id": "1", "price": "2.5"}])
    store = Warehouse(spark, store_root)
    publish_orders_serving(store, raw)
    rows = store.read("orders").collect()
    assert [(r.order_id, r.items_count, str(r.total_items_value)) for r in rows] == [("o1", 1, "2.50")]

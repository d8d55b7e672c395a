"""Incremental loading: watermark, log, publish, refresh, replay, backlog parity."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.session import scratch_path
from ledgerline.sources.binding import bind_raw
from ledgerline.streaming import state
from ledgerline.streaming.backlog import assign_batches, batch_edges, first_bad_edges, run_backlog
from ledgerline.streaming.pipeline import full_refresh, run_pipeline
from ledgerline.streaming.publish import Warehouse

SMALL = "/root/testdata/sf0.001"


def o(oid, ts, cust="c1"):
    return {"order_id": oid, "customer_id": cust, "order_purchase_timestamp": ts}


def state_rows(store, table):
    df = store.read(table)
    drop = [c for c in ("loaded_at", "updated_at", "started_at", "finished_at") if c in df.columns]
    return sorted(tuple(r) for r in df.drop(*drop).collect())


def test_batch_size_validation(spark, make_raw, store_root):
    store = Warehouse(spark, store_root)
    raw = make_raw()
    for bad in (0, -1, 5001):
        with pytest.raises(ValueError):
            run_pipeline(spark, raw, store, batch_size=bad)


def test_r14_r15_audit_kept_batch_overwritten(spark, make_raw, store_root):
    raw = make_raw(orders=[o("o1", "2017-01-01 00:00:00"), o("o2", "2017-01-02 00:00:00")],
                   customers=[{"customer_id": "c1", "customer_city": "x"}])
    store = Warehouse(spark, store_root)
    assert run_pipeline(spark, raw, store, batch_size=1, max_batches=1) == 1
    first = store.read("dim_customer").first()
    assert first.source_batch_id == 1
    assert run_pipeline(spark, raw, store, batch_size=1) == 1
    second = store.read("dim_customer").first()
    assert second.source_batch_id == 2 and second.updated_at == first.updated_at
    wm = store.read("etl_watermarks").first()
    assert (wm.last_order_id, str(wm.last_order_purchase_timestamp)) == ("o2", "2017-01-02 00:00:00")


def test_r16_only_reachable_entities(spark, make_raw, store_root):
    raw = make_raw(orders=[o("o1", "2017-01-01 00:00:00")],
                   items=[{"order_id": "o1", "order_item_id": "1", "product_id": "p1", "seller_id": "s1"}],
                   products=[{"product_id": "p1"}, {"product_id": "p_never"}],
                   sellers=[{"seller_id": "s1"}, {"seller_id": "s_never"}])
    store = Warehouse(spark, store_root)
    run_pipeline(spark, raw, store, batch_size=10)
    assert [r.product_id for r in store.read("dim_product").collect()] == ["p1"]
    assert [r.seller_id for r in store.read("dim_seller").collect()] == ["s1"]


def test_r18_watermark_from_raw_rows(spark, make_raw, store_root):
    raw = make_raw(orders=[o("o1", "2017-01-01 00:00:00"), o("o2", "2017-01-02 00:00:00", cust=None)])
    store = Warehouse(spark, store_root)
    run_pipeline(spark, raw, store, batch_size=10)
    assert store.read("stg_orders").count() == 1
    assert store.read("etl_watermarks").first().last_order_id == "o2"


def test_r19_late_rows_ignored_until_refresh(spark, make_raw, store_root):
    store = Warehouse(spark, store_root)
    run_pipeline(spark, make_raw(orders=[o("o2", "2017-01-02 00:00:00")]), store, batch_size=10)
    late = make_raw(orders=[o("o2", "2017-01-02 00:00:00"), o("o1", "2017-01-01 00:00:00")])
    assert run_pipeline(spark, late, store, batch_size=10) == 0
    assert [r.order_id for r in store.read("stg_orders").collect()] == ["o2"]
    run_pipeline(spark, late, store, batch_size=10, refresh=True)
    assert sorted(r.order_id for r in store.read("stg_orders").collect()) == ["o1", "o2"]


def test_r25_null_id_at_batch_end_fails_and_keeps_watermark(spark, make_raw, store_root):
    store = Warehouse(spark, store_root)
    raw = make_raw(orders=[o("o1", "2017-01-01 00:00:00"), o(None, "2017-01-02 00:00:00")])
    with pytest.raises(Exception, match="last_order_id"):
        run_pipeline(spark, raw, store, batch_size=10)
    assert store.read("etl_watermarks").count() == 0
    log = store.read("etl_batch_log").collect()
    assert [(r.batch_id, r.status) for r in log] == [(1, "failed")]
    assert store.read("fact_orders").count() == 0


def test_r10_bad_purchase_timestamp_fails_before_log(spark, make_raw, store_root):
    store = Warehouse(spark, store_root)
    with pytest.raises(Exception):
        run_pipeline(spark, make_raw(orders=[o("o1", "bad")]), store, batch_size=10)
    assert store.read("etl_batch_log").count() == 0


def test_k11_full_refresh_keeps_log(spark, store_root):
    raw = bind_raw(spark, SMALL)
    store = Warehouse(spark, store_root)
    assert run_backlog(spark, raw, store, batch_size=500) == 3
    full_refresh(store)
    assert all(store.read(t).count() == 0 for t in schemas.WAREHOUSE_TABLES)
    assert store.read("etl_watermarks").count() == 0
    assert store.read("etl_batch_log").count() == 3
    assert state.next_batch_id(store.read("etl_batch_log")) == 4


def test_b8_crash_before_swap_leaves_old_state(spark, store_root, monkeypatch):
    raw = bind_raw(spark, SMALL)
    store = Warehouse(spark, store_root)
    run_pipeline(spark, raw, store, batch_size=500, max_batches=1)
    before = {t: state_rows(store, t) for t in ("fact_orders", "etl_watermarks")}
    real = Warehouse.publish
    calls = {"n": 0}

    def crashing(self, changes, **kwargs):
        if "fact_orders" in changes:  # the data publish of the second batch
            calls["n"] += 1
            raise RuntimeError("executor lost before the manifest swap")
        return real(self, changes, **kwargs)

    monkeypatch.setattr(Warehouse, "publish", crashing)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, raw, store, batch_size=500, max_batches=1)
    monkeypatch.setattr(Warehouse, "publish", real)
    fresh = Warehouse(spark, store_root)
    assert calls["n"] == 1
    assert {t: state_rows(fresh, t) for t in before} == before
    assert [r.status for r in fresh.read("etl_batch_log").orderBy("batch_id").collect()] == ["completed", "failed"]


def test_backlog_equals_loop_for_several_batch_sizes(spark):
    raw = bind_raw(spark, SMALL)
    for size in (7, 400, 5000):
        a = Warehouse(spark, scratch_path(spark, "loop")) if size >= 400 else None
        b = Warehouse(spark, scratch_path(spark, "backlog"))
        nb = run_backlog(spark, raw, b, batch_size=size)
        assert nb == -(-raw["raw_orders"].count() // size)
        if a is not None:
            run_pipeline(spark, raw, a, batch_size=size)
            for t in [*schemas.WAREHOUSE_TABLES, "etl_watermarks", "etl_batch_log"]:
                assert state_rows(a, t) == state_rows(b, t), t


def test_batch_invariance_except_lineage(spark):
    """Final data does not depend on the batch size (order ids are unique here)."""
    raw = bind_raw(spark, SMALL)
    snapshots = []
    for size in (1, 7, 5000):
        store = Warehouse(spark, scratch_path(spark, "inv"))
        run_backlog(spark, raw, store, batch_size=size)
        snapshots.append({t: sorted(tuple(r) for r in store.read(t).drop("source_batch_id", "loaded_at", "updated_at")
                                    .collect()) for t in schemas.WAREHOUSE_TABLES})
    assert snapshots[0] == snapshots[1] == snapshots[2]


def test_straddling_duplicates_match_the_loop(spark, make_raw):
    rows = [o("o1", "2017-01-01 00:00:00"), o("o2", "2017-01-02 00:00:00", cust="a"),
            o("o2", "2017-01-02 00:00:00", cust="b"), o("o3", "2017-01-03 00:00:00"),
            o("o4", "2017-01-04 00:00:00"), o("o5", "2017-01-05 00:00:00")]
    raw = make_raw(orders=rows)
    assert first_bad_edges(batch_edges(assign_batches(raw["raw_orders"], 2))) == (1, None)
    loop, backlog = (Warehouse(spark, scratch_path(spark, n)) for n in ("loop", "backlog"))
    # The loop skips the second o2 copy; later batches shift by one row.
    assert run_pipeline(spark, raw, loop, batch_size=2) == 3
    assert run_backlog(spark, raw, backlog, batch_size=2) == 3
    log = backlog.read("etl_batch_log").orderBy("batch_id").collect()
    assert [(r.batch_size, r.source_max_order_id) for r in log] == [(2, "o2"), (2, "o4"), (1, "o5")]
    for t in [*schemas.WAREHOUSE_TABLES, "etl_watermarks", "etl_batch_log"]:
        assert state_rows(loop, t) == state_rows(backlog, t), t


def test_conservation_of_item_value(spark):
    raw = bind_raw(spark, SMALL)
    store = Warehouse(spark, scratch_path(spark, "cons"))
    run_backlog(spark, raw, store, batch_size=400)
    f = store.read("fact_orders").agg(F.sum("total_item_value")).first()[0]
    from ledgerline.plans.build import full_clean
    c = full_clean(raw)
    items = c.items.join(c.orders.select("order_id").distinct(), "order_id", "left_semi")
    unrounded = items.agg(F.sum("price")).first()[0]
    # Each order's total is rounded once to 2 dp: at most half a cent per order.
    assert abs(float(f) - float(unrounded)) <= 0.005 * store.read("fact_orders").count()


def test_grain_uniqueness(spark):
    raw = bind_raw(spark, SMALL)
    store = Warehouse(spark, scratch_path(spark, "grain"))
    run_backlog(spark, raw, store, batch_size=400)
    for t, (_, keys) in schemas.WAREHOUSE_TABLES.items():
        df = store.read(t)
        assert df.count() == df.select(*keys).distinct().count(), t


def test_b8_failure_after_table_writes_before_manifest(spark, store_root, monkeypatch):
    """Tables of batch 2 are fully written, but the manifest swap fails: nothing of batch 2 is
    visible, and a retry neither trips over nor picks up the orphaned files."""
    raw = bind_raw(spark, SMALL)
    store = Warehouse(spark, store_root)
    run_pipeline(spark, raw, store, batch_size=500, max_batches=1)
    before = {t: state_rows(store, t) for t in ("fact_orders", "stg_order_items", "etl_watermarks")}
    real = Warehouse._write_manifest
    calls = {"n": 0}

    def failing(self, rows, version, attempt):
        if version == 4 and calls["n"] == 0:
            # Batch 1 published versions 1 (log opened) and 2 (data); batch 2 opened its log
            # row as version 3, so version 4 is batch 2's data publish.
            calls["n"] += 1
            raise RuntimeError("lost before the pointer swap")
        return real(self, rows, version, attempt)

    monkeypatch.setattr(Warehouse, "_write_manifest", failing)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, raw, store, batch_size=500, max_batches=1)
    fresh = Warehouse(spark, store_root)
    assert calls["n"] == 1
    assert {t: state_rows(fresh, t) for t in before} == before
    assert [r.status for r in fresh.read("etl_batch_log").orderBy("batch_id").collect()] == ["completed", "failed"]
    # Retry: batch 2 is redone as batch 3; no duplicates from the orphaned attempt.
    run_pipeline(spark, raw, fresh, batch_size=500)
    ref = Warehouse(spark, scratch_path(spark, "ref"))
    run_pipeline(spark, raw, ref, batch_size=500)
    for t in ("stg_order_items", "fact_order_items", "stg_payments", "stg_reviews"):
        a = fresh.read(t).drop("source_batch_id", "loaded_at", "updated_at")
        b = ref.read(t).drop("source_batch_id", "loaded_at", "updated_at")
        assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect()), t


def test_day_layout_grain_backlog_then_loop(spark):
    """Day-grain layout; a backlog pass followed by loop batches equals one full backlog."""
    from ledgerline.streaming.publish import LAYOUT_FORMAT_CONF
    raw = bind_raw(spark, SMALL)
    ref = Warehouse(spark, scratch_path(spark, "ref"))
    run_backlog(spark, raw, ref, batch_size=400)
    spark.conf.set(LAYOUT_FORMAT_CONF, "yyyy-MM-dd")
    try:
        mixed = Warehouse(spark, scratch_path(spark, "day"))
        assert run_backlog(spark, raw, mixed, batch_size=400, max_batches=2) == 2
        assert run_pipeline(spark, raw, mixed, batch_size=400) == 2
        assert all(len(p) == 10 for p in mixed.fragments("fact_orders"))
    finally:
        spark.conf.unset(LAYOUT_FORMAT_CONF)
    for t in [*schemas.WAREHOUSE_TABLES, "etl_watermarks", "etl_batch_log"]:
        assert state_rows(ref, t) == state_rows(mixed, t), t


def test_r10_bad_timestamp_in_bronze_still_fails(spark, make_raw, store_root):
    from ledgerline.sources import ingest
    raw = make_raw(orders=[o("o1", "2017-01-01 00:00:00"), o("o2", "bad")])
    paths = ingest.write_bronze({"raw_orders": raw["raw_orders"]}, scratch_path(spark, "bronze"))
    bronze = dict(raw, raw_orders=spark.read.parquet(paths["raw_orders"]))
    assert "_purchase_ts" in bronze["raw_orders"].columns
    with pytest.raises(Exception, match="invalid timestamp"):
        run_pipeline(spark, bronze, Warehouse(spark, store_root), batch_size=10)


def run_both(spark, raw, size):
    """Loop and backlog over the same rows; each store with what the run raised."""
    out = []
    for name, run in (("loop", run_pipeline), ("backlog", run_backlog)):
        store, error = Warehouse(spark, scratch_path(spark, name)), None
        try:
            run(spark, raw, store, batch_size=size)
        except Exception as exc:
            error = str(exc)
        out.append((store, error))
    return out


def assert_equal_stores(loop, backlog):
    for t in [*schemas.WAREHOUSE_TABLES, "etl_watermarks", "etl_batch_log"]:
        assert state_rows(loop, t) == state_rows(backlog, t), t


def test_backlog_equals_loop_for_two_spellings_of_one_time(spark, make_raw):
    raw = make_raw(orders=[o("a", "2020-01-01 00:00:00"), o("b", "2020-01-02 00:00:00", cust="x"), o("b", "2020-01-02T00:00:00.0", cust="y"),
                           o("c", "2020-01-03 00:00:00")])
    (loop, e1), (backlog, e2) = run_both(spark, raw, 2)
    assert e1 is None and e2 is None
    assert [r.batch_size for r in backlog.read("etl_batch_log").orderBy("batch_id").collect()] == [2, 1]
    assert_equal_stores(loop, backlog)


@pytest.mark.parametrize("at", [0, 1, 2, 3, 4, 5])
def test_backlog_equals_loop_with_a_null_id_anywhere(spark, make_raw, at):
    rows = [o(f"o{i}", f"2020-01-0{i + 1} 00:00:00") for i in range(6)]
    rows[at] = o(None, rows[at]["order_purchase_timestamp"])
    raw = make_raw(orders=rows)
    (loop, e1), (backlog, e2) = run_both(spark, raw, 2)
    assert (e1 is None) == (e2 is None) == (at % 2 == 0) and e1 == e2
    assert_equal_stores(loop, backlog)


def test_backlog_equals_loop_when_a_null_id_shares_the_edge_time(spark, make_raw):
    raw = make_raw(orders=[o("a", "2020-01-01 00:00:00"), o("b", "2020-01-02 00:00:00"), o(None, "2020-01-02 00:00:00"), o("c", "2020-01-03 00:00:00"),
                           o("d", "2020-01-04 00:00:00")])
    (loop, e1), (backlog, e2) = run_both(spark, raw, 2)
    assert e1 is None and e2 is None
    assert_equal_stores(loop, backlog)


def test_backlog_logs_running_then_failed(spark, make_raw, monkeypatch):
    from ledgerline.streaming import backlog as module
    raw = make_raw(orders=[o("a", "2020-01-01 00:00:00"), o("b", "2020-01-02 00:00:00")])
    store, seen = Warehouse(spark, scratch_path(spark, "backlog")), []

    def lost(*args, **kwargs):
        seen.extend((r.batch_id, r.status) for r in Warehouse(spark, store.root).read("etl_batch_log").collect())
        raise RuntimeError("x" * 3000)

    monkeypatch.setattr(module, "publish_planned", lost)
    with pytest.raises(RuntimeError):
        run_backlog(spark, raw, store, batch_size=1)
    assert seen == [(1, "running")]
    (row,) = store.read("etl_batch_log").collect()
    assert row.status == "failed" and row.message == "x" * 1000 and store.read("stg_orders").count() == 0
    monkeypatch.undo()
    assert run_backlog(spark, raw, store, batch_size=1) == 2
    log = store.read("etl_batch_log").orderBy("batch_id").collect()
    assert [(r.batch_id, r.status) for r in log] == [(1, "failed"), (2, "completed"), (3, "completed")]
    assert all(r.started_at <= r.finished_at for r in log)


def test_items_of_orders_in_several_spellings_are_counted_per_batch(spark, make_raw):
    orders = [o("k", "2020-01-01 00:00:00"), o(" k", "2020-01-02 00:00:00"), o("m", "2020-01-03 00:00:00"), o("k ", "2020-01-04 00:00:00")]
    items = [{"order_id": i, "order_item_id": str(n)} for i in ("k", " k", "k ", "m") for n in (1, 1, 2)]
    for size in (1, 2, 3):
        (loop, e1), (backlog, e2) = run_both(spark, make_raw(orders=orders, items=items), size)
        assert e1 is None and e2 is None
        assert_equal_stores(loop, backlog)


def test_the_largest_batch_is_a_parameter(spark, make_raw):
    raw = make_raw(orders=[o("a", "2020-01-01 00:00:00")])
    store = Warehouse(spark, scratch_path(spark, "big"))
    with pytest.raises(ValueError):
        run_backlog(spark, raw, store, batch_size=6000)
    assert run_backlog(spark, raw, store, batch_size=6000, max_batch_size=6000) == 1


def test_no_table_is_published_with_nulls_or_repeated_keys(spark):
    from ledgerline.plans.store import ConstraintViolation
    store = Warehouse(spark, scratch_path(spark, "gate"))
    columns = "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string, source_batch_id long"

    def rows(*ids):
        df = spark.createDataFrame([(i, "u", 1, "c", "s", 1) for i in ids], columns)
        return df.withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))

    store.publish({"stg_customers": rows("a", "b")})
    with pytest.raises(ConstraintViolation, match="stg_customers primary_key:customer_id=1"):
        store.publish({"stg_customers": rows("a", "a")})
    with pytest.raises(Exception, match="null value in column customer_id of stg_customers"):
        store.publish({"stg_customers": rows("a", None)})
    with pytest.raises(Exception, match="null value in column last_order_id"):
        store.publish({"etl_watermarks": spark.createDataFrame(
            [("p", None)], "pipeline_name string, last_order_id string").withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz"))
            .withColumn("last_order_purchase_timestamp", F.col("updated_at"))})
    assert sorted(r.customer_id for r in Warehouse(spark, store.root).read("stg_customers").collect()) == ["a", "b"]


def test_another_layout_format_is_refused(spark):
    from ledgerline.streaming.publish import LAYOUT_FORMAT_CONF
    raw = bind_raw(spark, SMALL)
    store = Warehouse(spark, scratch_path(spark, "layout"))
    run_backlog(spark, raw, store, batch_size=400, max_batches=1)
    spark.conf.set(LAYOUT_FORMAT_CONF, "yyyy")
    try:
        with pytest.raises(ValueError, match="laid out by yyyy-MM"):
            run_backlog(spark, raw, Warehouse(spark, store.root), batch_size=400, max_batches=1)
        assert run_backlog(spark, raw, Warehouse(spark, store.root), batch_size=400, max_batches=1, refresh=True) == 1
    finally:
        spark.conf.unset(LAYOUT_FORMAT_CONF)


def test_locator_finds_the_period_an_order_moves_from(spark, make_raw):
    """An id that comes again in a later month leaves its old period; one locator read answers for all six tables."""
    first = [o("k", "2020-01-05 00:00:00"), o("other", "2020-01-06 00:00:00"), o("m", "2020-02-01 00:00:00")]
    items = [{"order_id": "k", "order_item_id": "1"}, {"order_id": "other", "order_item_id": "1"}]
    store = Warehouse(spark, scratch_path(spark, "moves"))
    run_pipeline(spark, make_raw(orders=first, items=items), store, batch_size=10)
    assert sorted(map(tuple, store.read(schemas.LOCATOR).collect())) == [("k", "2020-01"), ("m", "2020-02"), ("other", "2020-01")]
    before = store.fragments("fact_orders")
    raw = make_raw(orders=[*first, o("k", "2020-03-01 00:00:00")], items=items)
    run_pipeline(spark, raw, store, batch_size=10)
    months = {t: sorted((r.order_id, r.layout_period) for r in store.read(t, layout=True).collect()) for t in ("fact_orders", "stg_order_items")}
    assert months == {"fact_orders": [("k", "2020-03"), ("m", "2020-02"), ("other", "2020-01")], "stg_order_items": [("k", "2020-03"), ("other", "2020-01")]}
    after = store.fragments("fact_orders")
    assert after["2020-02"] == before["2020-02"] and after["2020-01"] != before["2020-01"]
    assert store.written_rows["fact_orders"] == 2 and store.written_rows["dim_customer"] == store.read("dim_customer").count()
    # A period that loses its last row drops out.
    run_pipeline(spark, make_raw(orders=[*first, o("m", "2020-04-01 00:00:00")]), store, batch_size=10)
    assert "2020-02" not in store.fragments("stg_orders") and "2020-04" in store.fragments("stg_orders")


def test_a_store_without_a_locator_gets_one(spark):
    raw = bind_raw(spark, SMALL)
    ref, old = (Warehouse(spark, scratch_path(spark, n)) for n in ("ref", "old"))
    run_backlog(spark, raw, ref, batch_size=400)
    run_backlog(spark, raw, old, batch_size=400, max_batches=2)
    old.publish({schemas.LOCATOR: None})
    assert run_pipeline(spark, raw, old, batch_size=400) == 2
    assert_equal_stores(ref, old)
    assert state_rows(ref, schemas.LOCATOR) == state_rows(old, schemas.LOCATOR)

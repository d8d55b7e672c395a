"""Physical-plan checks: semi joins, no Python in the hot path, no single-partition steps."""

from __future__ import annotations

from ledgerline.operators.closure import semi_by
from ledgerline.plans import build
from ledgerline.plans.registry import QUERIES
from ledgerline.sources.binding import bind_raw

SMALL = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    """The static physical plan (AQE off, so whole-stage codegen stages are visible)."""
    spark = df.sparkSession
    prior = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prior)


def test_flagship_has_no_python_and_no_single_partition(spark):
    p = plan_text(build.full_fact_orders(bind_raw(spark, SMALL)))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "SinglePartition" not in p
    assert "WholeStageCodegen" in p or "*(" in p


def test_semi_joins_are_left_semi(spark):
    raw = bind_raw(spark, SMALL)
    orders = build.eligible_orders(raw["raw_orders"])
    p = plan_text(semi_by(raw["raw_order_items"], orders, "order_id"))
    assert "LeftSemi" in p
    b = plan_text(semi_by(raw["raw_order_items"], orders.limit(10), "order_id", bounded=True))
    assert "BroadcastHashJoin" in b and "LeftSemi" in b


def test_projection_pruned_at_scan(spark):
    from ledgerline.sources.tables import read_table
    p = plan_text(read_table(spark, f"{SMALL}/customer.parquet", ["c_custkey", "c_mktsegment"]))
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in p


def test_keyset_predicate_pushed_on_typed_column(spark):
    from pyspark.sql import functions as F
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    a = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    df = orders.where((F.col("o_orderdate") > a) | ((F.col("o_orderdate") == a) & (F.col("o_orderkey") > 10)))
    assert "PushedFilters: [Or(GreaterThan(o_orderdate" in plan_text(df)


def test_global_rank_avoids_single_partition_window(spark):
    from ledgerline.streaming.backlog import assign_batches
    p = plan_text(assign_batches(bind_raw(spark, SMALL)["raw_orders"], 100))
    assert "SinglePartition" not in p.split("BroadcastExchange")[0]


def test_keep_last_dedupe_limits_before_the_shuffle(spark):
    from ledgerline.plans import entities as E
    p = plan_text(E.clean_items(bind_raw(spark, SMALL)["raw_order_items"]))
    lines = [l for l in p.splitlines() if "WindowGroupLimit" in l or "Exchange hashpartitioning" in l]
    # top-down: final limit, exchange, partial (map-side) limit
    assert len(lines) >= 3 and "WindowGroupLimit" in lines[-1] and "Exchange" in lines[-2]


def test_keyset_scan_on_bronze_pushes_the_watermark(spark):
    from ledgerline.session import scratch_path
    from ledgerline.sources import ingest
    from ledgerline.streaming.batches import keyset_batch
    root = scratch_path(spark, "bronze-plan")
    paths = ingest.write_bronze({"raw_orders": bind_raw(spark, SMALL)["raw_orders"]}, root)
    bronze = spark.read.parquet(paths["raw_orders"])
    p = plan_text(keyset_batch(bronze, "1998-01-01 00:00:00", "", 100))
    assert "PushedFilters: [Or(GreaterThanOrEqual(_purchase_ts,1998-01-01T00:00)" in p
    rows = keyset_batch(bronze, "1998-01-01 00:00:00", "", 100).collect()
    ref = keyset_batch(bind_raw(spark, SMALL)["raw_orders"], "1998-01-01 00:00:00", "", 100).collect()
    assert [r.order_id for r in rows] == [r.order_id for r in ref]


def test_bounded_closure_prunes_bronze_children_by_key_range(spark):
    from ledgerline.operators.closure import batch_closure
    from ledgerline.session import scratch_path
    from ledgerline.sources import ingest
    raw = bind_raw(spark, SMALL)
    paths = ingest.write_bronze({"raw_order_items": raw["raw_order_items"]}, scratch_path(spark, "bronze-items"))
    bronze = dict(raw, raw_order_items=spark.read.parquet(paths["raw_order_items"]))
    batch = build.eligible_orders(raw["raw_orders"]).orderBy("order_id").limit(50).checkpoint()
    c = batch_closure(bronze, batch, bounded=True)
    assert "PushedFilters: [IsNotNull(order_id), GreaterThanOrEqual(order_id," in plan_text(c.items)
    ref = batch_closure(raw, batch, bounded=False).items
    assert sorted(tuple(r) for r in c.items.collect()) == sorted(tuple(r) for r in ref.collect())


def test_long_generated_code_is_not_left_to_the_interpreter(spark):
    """A registered query sets the limit in whatever session it gets: stages beyond 8000 bytes of code run operator by operator."""
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
        QUERIES["clean_items"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)

"""Keyset batches over raw orders and the work of one batch."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import clean_text, strict_timestamp
from ..operators.bounds import batch_bounds
from ..operators.closure import Closure, batch_closure
from ..operators.keys import dedupe_keep_last
from ..operators.upsert import first_rows, upsert
from ..plans.build import CleanBatch, clean_batch, eligible_orders
from ..plans.facts import build_fact_orders
from ..plans.store import typed
from ..session import drop_path, drop_unused_shuffles, scratch_path
from .publish import LAYOUT_COL, ORDER_GRAIN, STORED_AS, Warehouse, month_of

# Default and maximum orders per batch.
DEFAULT_BATCH_SIZE = 5_000
MAX_BATCH_SIZE = 5_000
#: Key sets are broadcast only when they were counted and are no larger (a few MB of ids).
BROADCAST_ROWS = 50_000


#: The parsed purchase time as a column to sort by: a sort evaluates an expression anew for every comparison.
PURCHASED = "_purchased"


def with_purchase_time(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.withColumn(PURCHASED, strict_timestamp("order_purchase_timestamp"))


def purchase_order(raw_orders: DataFrame) -> list[Column]:
    """The batch order of orders with their parsed purchase time: that time, then raw order id (NULLs last).

    The remaining raw columns follow as tie-breakers, so rows sharing a
    (time, id) pair are cut at a batch edge the same way by the loop and by
    backlog mode (the source leaves this order undefined).
    """
    rest = [c for c in raw_orders.columns if c not in ("order_purchase_timestamp", "order_id")
            and not c.startswith("_")]
    return [F.col(PURCHASED).asc(), F.col("order_id").asc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in rest]]


def keyset_batch(raw_orders: DataFrame, after_ts: dt.datetime | str, after_id: str, batch_size: int) -> DataFrame:
    """The next ``batch_size`` raw orders strictly after the watermark, in batch order.

    ``orderBy().limit()`` plans as a top-N (``TakeOrderedAndProject``): each
    task keeps its best ``batch_size`` rows, so only ``tasks x batch_size``
    rows meet in the final merge.
    """
    ts = after_ts.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(after_ts, dt.datetime) else after_ts
    eligible = with_purchase_time(eligible_orders(raw_orders, ts, after_id))
    return eligible.orderBy(*purchase_order(raw_orders)).limit(batch_size).drop(PURCHASED)


def bounds_of(batch: DataFrame) -> DataFrame:
    return batch_bounds(batch.withColumn("_ts", strict_timestamp("order_purchase_timestamp")), "_ts", "order_id")


@dataclass
class BatchResult:
    planned: dict[str, "PlannedUpsert"]
    metrics: tuple[int, int, int, int]


def batch_months(batch_orders: DataFrame) -> DataFrame:
    """Raw order id -> layout month (latest purchase time of that id in the batch)."""
    return (batch_orders.where(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(month_of(F.max(strict_timestamp("order_purchase_timestamp"))).alias("_month")))


def _layout(df: DataFrame, schema, month: Column) -> DataFrame:
    return typed(df, schema, lineage=("source_batch_id", "_month")).withColumn(LAYOUT_COL, month).drop("_month")


def batch_outputs(clean: CleanBatch, batch_id: int | Column) -> dict[str, DataFrame]:
    """New rows per warehouse table for one batch (typed, with ``source_batch_id``).

    Order-grain tables also carry ``layout_period``: the purchase month for
    orders, the month of the batch order that fetched them for children.
    """
    orders_latest = dedupe_keep_last(clean.orders, ["order_id"])
    fact = build_fact_orders(clean.orders, clean.items, clean.payments, clean.reviews, batch_id)
    items = _layout(clean.items, schemas.ORDER_ITEMS, F.col("_month"))
    return {
        "stg_orders": _layout(orders_latest, schemas.STG_ORDERS, month_of(F.col("purchased_at"))),
        "stg_customers": typed(clean.customers, schemas.CUSTOMERS),
        "stg_products": typed(clean.products, schemas.PRODUCTS),
        "stg_sellers": typed(clean.sellers, schemas.SELLERS),
        "stg_order_items": items,
        "stg_payments": _layout(clean.payments, schemas.PAYMENTS, F.col("_month")),
        "stg_reviews": _layout(clean.reviews, schemas.REVIEWS, F.col("_month")),
        "dim_customer": typed(clean.customers, schemas.CUSTOMERS),
        "dim_product": typed(clean.products, schemas.PRODUCTS),
        "dim_seller": typed(clean.sellers, schemas.SELLERS),
        "fact_order_items": items,
        "fact_orders": fact.withColumn(LAYOUT_COL, month_of(F.col("purchased_at"))),
    }


@dataclass
class PlannedUpsert:
    df: DataFrame                 # new content of the table (or of its touched periods)
    touched: set[str] | None      # periods replaced; None = whole table
    release: Callable[[], None] | None = None  # called when the rows are written: then what they were made of may go


def order_periods(orders: DataFrame, months: DataFrame) -> DataFrame:
    """(order_id, period), once each: where the new rows of cleaned orders and of the raw ids' children go.

    ``months`` is (raw order id, ``_month``): all children that a batch fetches lie in the period of the id that fetched them.
    """
    own = orders.select("order_id", month_of(F.col("purchased_at")).alias("period"))
    fetched = months.select(clean_text("order_id").alias("order_id"), F.col("_month").alias("period"))
    return own.unionByName(fetched).where(F.col("order_id").isNotNull() & F.col("period").isNotNull()).distinct()


def locator(store: Warehouse, parts: set[str] | None = None) -> DataFrame:
    """The store's (order_id, period) pairs; of a store written without a locator, the keys of its order-grain tables."""
    if store.fragments(schemas.LOCATOR):
        return store.read(schemas.LOCATOR, parts=parts)
    held = [store.read(t, parts=parts, layout=True).select("order_id", F.col(LAYOUT_COL).alias("period"))
            for t in sorted(ORDER_GRAIN) if store.fragments(t)]
    empty = store.read(schemas.LOCATOR)
    return reduce(DataFrame.unionByName, held, empty).distinct()


def located(store: Warehouse, pairs: DataFrame, bounded: bool = False) -> set[str]:
    """The periods that an upsert of these orders touches: their new ones, and those that hold older rows of them.

    One read of the locator answers for all order-grain tables; only period names, a short list, reach the driver.
    """
    ids = pairs.select("order_id")
    older = locator(store).join(F.broadcast(ids) if bounded else ids, "order_id", "left_semi").select("period")
    return {r.period for r in pairs.select("period").unionByName(older).distinct().collect()}


def plan_upserts(store: Warehouse, outputs: dict[str, DataFrame], pairs: DataFrame, new_rows: dict[str, int] | None = None) -> dict[str, PlannedUpsert]:
    """The upserts of ``outputs``; of order-grain tables only the touched periods are read and written, the locator's as well.

    ``pairs`` are the (order_id, period) of all new order-grain rows, or more. ``new_rows`` are counted rows of the new
    frames: only those within ``BROADCAST_ROWS`` are broadcast. An id keeps the periods it was ever located in
    (a later batch then rewrites a period in vain at worst); a full refresh forgets them.
    """
    def bounded(table: str) -> bool:
        return (new_rows or {}).get(table, BROADCAST_ROWS + 1) <= BROADCAST_ROWS

    touched = located(store, pairs, bounded(schemas.LOCATOR))
    planned = {}
    for table, new in outputs.items():
        _, keys = schemas.WAREHOUSE_TABLES[table]
        parts = touched if table in ORDER_GRAIN else None
        target, audit = store.read(table, parts=parts, layout=True), schemas.audit_column(table)
        held = store.fragments(table).keys() & parts if parts is not None else store.fragments(table)
        df = upsert(target, new, keys, audit=audit, new_bounded=bounded(table)) if held else first_rows(target, new, audit=audit)
        planned[table] = PlannedUpsert(df, parts)
    whole = not store.fragments(schemas.LOCATOR)
    pairs = locator(store, None if whole else touched).unionByName(pairs).distinct().withColumn(LAYOUT_COL, F.col("period"))
    planned[schemas.LOCATOR] = PlannedUpsert(pairs, None if whole else touched)
    return planned


# Which cleaned frame each warehouse table's new rows come from.
SOURCE_OF = {"stg_orders": "orders", "fact_orders": "orders", "stg_order_items": "items", "fact_order_items": "items",
             "stg_payments": "payments", "stg_reviews": "reviews", "stg_customers": "customers", "dim_customer": "customers",
             "stg_products": "products", "dim_product": "products", "stg_sellers": "sellers", "dim_seller": "sellers"}


class Staged:
    """Intermediate frames of one batch or pass as tables in a scratch folder, with the row counts that the writing jobs observed.

    A written frame has no lineage: plans that use it twice (an upsert joins its new rows with themselves) stay small and
    nothing is computed again, where a persisted frame is recomputed under a self-join's renamed columns. Range
    partitioning samples its input by computing it: of a written frame it samples the file.

    A ``spare`` one is for frames as large as the input: they are written one after another, each one's shuffle files go when it is
    written, so that disk holds those of one at a time. What no later frame reads can be dropped.
    """

    def __init__(self, spark: SparkSession, parallelism: int = 8, spare: bool = False):
        self.spark, self.parallelism, self.spare = spark, parallelism, spare
        self.folder = scratch_path(spark, "batch")
        self.rows: dict[str, int] = {}

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        path, seen = f"{self.folder}/{name}", Observation(f"{name}-{uuid.uuid4().hex[:12]}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", STORED_AS).parquet(path)
        self.rows[name] = seen.get["rows"]
        if self.spare:
            drop_unused_shuffles(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_all(self, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Independent frames, written by concurrent jobs (unless ``spare``)."""
        with ThreadPoolExecutor(max_workers=1 if self.spare else self.parallelism) as pool:
            return dict(zip(frames, pool.map(self.keep, frames, frames.values())))

    def __enter__(self) -> "Staged":
        return self

    def __exit__(self, *exc: object) -> None:
        self.drop()

    def drop(self, *names: str) -> None:
        """Delete frames that nothing reads any more; without names all of them."""
        for path in [f"{self.folder}/{name}" for name in names] or [self.folder]:
            drop_path(self.spark, path)


@dataclass
class NewRows:
    """What a batch brings, whatever the store holds."""
    outputs: dict[str, DataFrame]  # new rows per warehouse table
    pairs: DataFrame               # (order_id, period) of its order-grain rows
    rows: dict[str, int]           # counted rows of the staged frames


def new_rows(spark: SparkSession, raw: dict[str, DataFrame], batch_orders: DataFrame, n_orders: int, batch_id: int,
             closure: Closure | None = None) -> NewRows:
    """Closure -> clean -> fact of one batch. The store is not read, so this may run while the batch before is published.

    ``batch_orders`` is written and has ``n_orders`` rows; ``closure`` is found in ``raw`` unless given. Every table's new rows are counted while they are staged, and only counted
    sets of at most ``BROADCAST_ROWS`` are broadcast: an order of a bounded batch may still hold any
    number of items.
    """
    staged = Staged(spark)
    bounded = n_orders <= BROADCAST_ROWS
    closure = closure or batch_closure(raw, batch_orders, bounded=bounded, keep=lambda items: staged.keep("raw_items", items))
    months = staged.keep("months", batch_months(batch_orders))
    clean = CleanBatch(**staged.keep_all(clean_batch(batch_orders, closure, batch_id, months=F.broadcast(months) if bounded else months).__dict__))
    outputs = batch_outputs(clean, batch_id)
    late = staged.keep_all({"fact_orders": outputs["fact_orders"], "pairs": order_periods(clean.orders, months)})
    outputs["fact_orders"] = late["fact_orders"]
    return NewRows(outputs, late["pairs"], staged.rows)


def process_batch(raw: dict[str, DataFrame], batch_orders: DataFrame, n_orders: int, batch_id: int, store: Warehouse,
                  closure: Closure | None = None, new: NewRows | None = None) -> BatchResult:
    """:func:`new_rows` of a batch, unless given -> upsert plans for every warehouse table."""
    new = new or new_rows(store.spark, raw, batch_orders, n_orders, batch_id, closure)
    rows = new.rows
    planned = plan_upserts(store, new.outputs, new.pairs, {schemas.LOCATOR: rows["pairs"], **{t: rows[k] for t, k in SOURCE_OF.items()}})
    # Metrics as the source logs them: input rows, duplicates included.
    return BatchResult(planned, (rows["orders"], rows["items"], rows["orders"], rows["items"]))


def publish_planned(store: Warehouse, planned: dict[str, PlannedUpsert], extra: dict[str, DataFrame],
                    sort_by: dict[str, list[str]] | None = None) -> int:
    """Publish planned upserts plus whole-table changes (state tables) in one manifest swap."""
    changes = {t: p.df for t, p in planned.items()}
    changes.update(extra)
    touched = {t: p.touched for t, p in planned.items() if p.touched is not None}
    release = {t: p.release for t, p in planned.items() if p.release is not None}
    return store.publish(changes, touched=touched, sort_by=sort_by, release=release)

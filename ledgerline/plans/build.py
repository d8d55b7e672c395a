"""Whole-table builds: one batch that holds every eligible order.

This is what a full refresh followed by a single unbounded batch produces,
expressed as one lazy plan per output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_text, strict_timestamp
from ..operators.closure import Closure, batch_closure, by_order_key
from ..operators.keys import ORDER_KEY
from ..session import scratch_path
from ..sources.ingest import PURCHASE_TS
from . import entities as E
from .facts import build_fact_orders

# Fixed value: the watermark before the first batch.
EPOCH_TS = "1900-01-01 00:00:00"


def eligible_orders(raw_orders: DataFrame, after_ts: str = EPOCH_TS, after_id: str = "") -> DataFrame:
    """Raw orders strictly after ``(after_ts, after_id)``; the purchase time is cast strictly.

    ``(ts, id) > (a, b)`` as one comparison, so the time is parsed once a row; a NULL id is the least of its time.
    """
    ts = strict_timestamp("order_purchase_timestamp")
    a = F.lit(after_ts).cast("timestamp_ntz")
    eligible = raw_orders
    if PURCHASE_TS in raw_orders.columns:
        # Redundant, pushable form on the typed bronze column: skips row groups
        # before the watermark; NULLs (unparsable text) stay for the strict cast.
        eligible = eligible.where((F.col(PURCHASE_TS) >= a) | F.col(PURCHASE_TS).isNull())
    return eligible.where(
        F.col("order_purchase_timestamp").isNotNull()
        & (F.struct(ts.alias("ts"), F.col("order_id").alias("id")) > F.struct(a.alias("ts"), F.lit(after_id).alias("id")))
    )


@dataclass
class CleanBatch:
    orders: DataFrame       # duplicates kept, with tie-break
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    items: DataFrame        # money still DECIMAL(18,6)
    payments: DataFrame
    reviews: DataFrame


def clean_batch(batch_orders: DataFrame, closure: Closure, batch_id: Column | int | None = None,
                months: DataFrame | None = None) -> CleanBatch:
    """Clean every table of a batch. ``months`` (raw order id -> ``_month``), when
    given, is attached to the order children and carried through cleaning."""
    carry: list[str] = []
    items, payments, reviews = closure.items, closure.payments, closure.reviews
    if months is not None:
        m = months.withColumnRenamed("order_id", "_m_order_id")

        def attach(rows: DataFrame) -> DataFrame:
            return rows.join(m, rows["order_id"] == m["_m_order_id"]).drop("_m_order_id")

        items, payments, reviews = attach(items), attach(payments), attach(reviews)
        carry = ["_month"]
    return CleanBatch(
        orders=E.clean_orders(batch_orders, batch_id, keep_tiebreak=True),
        customers=E.clean_customers(closure.customers, batch_id),
        products=E.clean_products(closure.products, closure.translations, batch_id),
        sellers=E.clean_sellers(closure.sellers, batch_id),
        items=E.clean_items(items, batch_id, carry=carry),
        payments=E.clean_payments(payments, batch_id, carry=carry),
        reviews=E.clean_reviews(reviews, batch_id, carry=carry),
    )


def full_clean(raw: dict[str, DataFrame]) -> CleanBatch:
    batch = eligible_orders(raw["raw_orders"])
    return clean_batch(batch, batch_closure(raw, batch))


def full_fact_orders(raw: dict[str, DataFrame]) -> DataFrame:
    """The order fact; children meet the orders by cleaned id, where they are deduped and summed as well.

    The eligible raw orders are written once: the cleaned orders and the ids that each kind of child is matched with come from them.
    """
    spark = raw["raw_orders"].sparkSession
    eligible, path = eligible_orders(raw["raw_orders"]).withColumn(ORDER_KEY, clean_text("order_id")), scratch_path(spark, "eligible")
    eligible.write.parquet(path)
    batch = spark.read.schema(eligible.schema).parquet(path)
    items, payments, reviews = (by_order_key(raw[name], batch) for name in ("raw_order_items", "raw_payments", "raw_reviews"))
    return build_fact_orders(E.clean_orders(batch, keep_tiebreak=True), E.clean_items(items), E.clean_payments(payments), E.clean_reviews(reviews))

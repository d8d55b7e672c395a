"""Order-grain fact, order-item fact and the dimensions of one batch.

Children are reduced to order grain before they meet the orders, so the
joins are 1:1 and cannot fan out; each ``groupBy`` is partially aggregated on
the map side, which also takes the edge off a hot order id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import days_between
from ..operators.keys import TIEBREAK, dedupe_keep_last
from .store import typed

ORDER_COLUMNS = [f.name for f in schemas.STG_ORDERS.fields]


def _zero_if_null_sum(col: str) -> Column:
    # A group whose values are all NULL sums to 0, not NULL.
    return F.coalesce(F.sum(col), F.lit(0))


def item_aggregates(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("order_item_count"),
        F.count_distinct("product_id").alias("distinct_product_count"),
        _zero_if_null_sum("price").alias("total_item_value"),
        _zero_if_null_sum("freight_value").alias("total_freight_value"),
    )


def payment_aggregates(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(_zero_if_null_sum("payment_value").alias("total_payment_value"))


def review_aggregates(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count("review_score").alias("review_count"),
    )


def build_fact_orders(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame,
                      batch_id: Column | int | None = None, measured: bool = False) -> DataFrame:
    """Cleaned orders + item / payment / review measures, typed as stored.

    An order without children keeps NULL sums and gets 0 counts. ``source_batch_id`` is ``batch_id``
    or else the order row's own, if it has one. With ``measured``, ``items`` are their
    :func:`item_aggregates`, which are by far the most to shuffle.
    """
    if TIEBREAK in orders.columns:
        orders = dedupe_keep_last(orders, ["order_id"])
    lineage = ["source_batch_id"] if batch_id is None and "source_batch_id" in orders.columns else []
    facts = (orders.select(*ORDER_COLUMNS, *lineage)
             .join(items if measured else item_aggregates(items), "order_id", "left")
             .join(payment_aggregates(payments), "order_id", "left")
             .join(review_aggregates(reviews), "order_id", "left"))
    facts = facts.select(
        *ORDER_COLUMNS,
        days_between("delivered_customer_at", "purchased_at").alias("delivery_days"),
        F.coalesce("order_item_count", F.lit(0)).alias("order_item_count"),
        F.coalesce("distinct_product_count", F.lit(0)).alias("distinct_product_count"),
        "total_item_value", "total_freight_value", "total_payment_value", "avg_review_score",
        F.coalesce("review_count", F.lit(0)).alias("review_count"), *lineage,
    )
    stored = typed(facts, schemas.FACT_ORDERS)
    if batch_id is not None:
        b = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
        stored = stored.withColumn("source_batch_id", b.cast("long"))
    return stored

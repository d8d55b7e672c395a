"""Batch closure: the related rows of a set of orders, via semi-joins.

Membership is always a ``left_semi`` join against a DataFrame of keys --
never an ``isin`` over collected ids -- so the key set can be any size. When
the caller has counted the orders and found them few it passes ``bounded=True``
and their keys are broadcast; the batch's items, whose number no batch size
bounds, and everything else are left to Spark and AQE.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean_text
from .keys import ORDER_KEY


def semi_by(rows: DataFrame, keys: DataFrame, row_col: str, key_col: str | None = None,
            bounded: bool = False) -> DataFrame:
    """Rows whose ``row_col`` is among the non-null ``key_col`` values of ``keys``."""
    key_col = key_col or row_col
    k = keys.where(F.col(key_col).isNotNull()).select(F.col(key_col).alias("_k"))
    if bounded:
        k = F.broadcast(k)
    return rows.join(k, rows[row_col] == k["_k"], "left_semi")


def by_order_key(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows whose raw order id is among those of ``orders``, with their cleaned id as ``ORDER_KEY`` (none without one), which ``orders`` have too.

    They are joined by the cleaned id and compared by the raw one: rows and orders then meet where the rows' dedupe and
    their sums by order happen too, so each row is moved once. As a second join key the raw id would deal the rows anew.
    """
    keys = (orders.select(F.col(ORDER_KEY).alias("_k"), F.col("order_id").alias("_raw_id"))
            .where(F.col("_k").isNotNull()).repartition("_k").distinct().hint("shuffle_hash"))
    keyed = rows.withColumn(ORDER_KEY, clean_text("order_id"))
    same_raw = F.array_contains(F.array("_raw_id"), keyed["order_id"])
    return keyed.join(keys, (keyed[ORDER_KEY] == keys["_k"]) & same_raw).drop("_k", "_raw_id")


@dataclass
class Closure:
    customers: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    products: DataFrame
    translations: DataFrame
    sellers: DataFrame


def key_range(keys: DataFrame, key_col: str) -> tuple[str, str] | None:
    """``(min, max)`` of a bounded key set -- two values for the driver; None if empty."""
    r = keys.agg(F.min(key_col).alias("lo"), F.max(key_col).alias("hi")).first()
    return None if r.lo is None else (r.lo, r.hi)


def within(rows: DataFrame, col: str, bounds: tuple[str, str] | None) -> DataFrame:
    """A literal range predicate Parquet can check against row-group min/max statistics."""
    if bounds is None:
        return rows.where(F.lit(False))
    return rows.where(F.col(col).between(F.lit(bounds[0]), F.lit(bounds[1])))


def batch_closure(raw: dict[str, DataFrame], batch_orders: DataFrame, bounded: bool = False,
                  keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> Closure:
    """Raw rows reachable from ``batch_orders``, matched on raw (uncleaned) keys.

    customers, items, payments and reviews hang off the orders; products and
    sellers off the batch's items; translations off the batch's products.
    For a bounded (materialised) batch the order-keyed and customer lookups
    also get the batch's key range as a literal predicate, so clustered bronze
    files outside it are skipped; the semi join still decides membership.
    ``keep`` may persist the items, which four of the results build on.
    """
    ids = cust = None
    if bounded:
        ids, cust = key_range(batch_orders, "order_id"), key_range(batch_orders, "customer_id")

    def by_order(name: str) -> DataFrame:
        rows = within(raw[name], "order_id", ids) if bounded else raw[name]
        return semi_by(rows, batch_orders, "order_id", bounded=bounded)

    items = keep(by_order("raw_order_items"))
    products = semi_by(raw["raw_products"], items, "product_id")
    customers = raw["raw_customers"] if not bounded else within(raw["raw_customers"], "customer_id", cust)
    return Closure(
        customers=semi_by(customers, batch_orders, "customer_id", bounded=bounded),
        items=items,
        payments=by_order("raw_payments"),
        reviews=by_order("raw_reviews"),
        products=products,
        translations=semi_by(raw["raw_translations"], products, "product_category_name"),
        sellers=semi_by(raw["raw_sellers"], items, "seller_id"),
    )

"""The denormalised ``orders`` serving table (full rebuild, no cleaning).

Only numbers are coerced; ids and text stay as landed. Items meet products
and orders meet customers on a null-safe key (NULL matches NULL), and
duplicate product or customer rows fan out, exactly as a dataframe merge does.
Order-grain aggregates are computed first, so their joins are 1:1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import strict_timestamp, to_number
from ..operators.nullsafe import left_join_null_safe
from .store import cast_to


def items_with_categories(items: DataFrame, products: DataFrame) -> DataFrame:
    return left_join_null_safe(items, products.select(F.col("product_id").alias("_p_id"), "product_category_name"), "product_id", "_p_id")


def orders_with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return left_join_null_safe(orders, customers.select(F.col("customer_id").alias("_c_id"), "customer_state"), "customer_id", "_c_id")


def sorted_distinct_text(col: str, sep: str = ", "):
    """Distinct non-null values in code-point order joined by ``sep``; NULL when none."""
    return F.expr(f"listagg(DISTINCT `{col}`, '{sep}') WITHIN GROUP (ORDER BY `{col}`)")


def serving_item_aggregates(items: DataFrame, products: DataFrame) -> DataFrame:
    joined = items_with_categories(items, products)
    return (joined.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.count("order_item_id").alias("items_count"),
        F.coalesce(F.sum(to_number("price")), F.lit(0)).alias("total_items_value"),
        F.coalesce(F.sum(to_number("freight_value")), F.lit(0)).alias("total_freight_value"),
        sorted_distinct_text("product_category_name").alias("product_categories"),
    ))


def serving_payment_sums(payments: DataFrame) -> DataFrame:
    return (payments.where(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.coalesce(F.sum(to_number("payment_value")), F.lit(0)).alias("total_payment_value")))


def serving_review_means(reviews: DataFrame) -> DataFrame:
    return (reviews.where(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.avg(to_number("review_score")).alias("avg_review_score")))


def build_orders_serving(raw: dict[str, DataFrame]) -> DataFrame:
    orders = orders_with_customers(raw["raw_orders"], raw["raw_customers"])
    df = (orders
          .join(serving_item_aggregates(raw["raw_order_items"], raw["raw_products"]), "order_id", "left")
          .join(serving_payment_sums(raw["raw_payments"]), "order_id", "left")
          .join(serving_review_means(raw["raw_reviews"]), "order_id", "left"))
    df = df.select(
        "order_id", "customer_id", "customer_state", "order_status",
        strict_timestamp("order_purchase_timestamp").alias("purchased_at"),
        strict_timestamp("order_delivered_customer_date").alias("delivered_at"),
        "items_count", "total_items_value", "total_freight_value", "total_payment_value",
        "avg_review_score", "product_categories",
    )
    return cast_to(df, schemas.ORDERS_SERVING)

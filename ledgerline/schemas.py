"""Target table schemas (one StructType per published table).

Used to type empty tables, to cast on store, and to validate before publish.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampNTZType()
MONEY = T.DecimalType(12, 2)


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


STG_ORDERS = _schema(
    ("order_id", S, False), ("customer_id", S, False), ("order_status", S, True),
    ("purchased_at", TS, False), ("approved_at", TS, True), ("delivered_carrier_at", TS, True),
    ("delivered_customer_at", TS, True), ("estimated_delivery_at", TS, True),
)
CUSTOMERS = _schema(
    ("customer_id", S, False), ("customer_unique_id", S, True), ("customer_zip_code_prefix", I, True),
    ("customer_city", S, True), ("customer_state", S, True),
)
PRODUCTS = _schema(
    ("product_id", S, False), ("product_category_name", S, True), ("product_category_name_english", S, True),
    ("product_name_length", I, True), ("product_description_length", I, True), ("product_photos_qty", I, True),
    ("product_weight_g", I, True), ("product_length_cm", I, True), ("product_height_cm", I, True),
    ("product_width_cm", I, True),
)
SELLERS = _schema(
    ("seller_id", S, False), ("seller_zip_code_prefix", I, True), ("seller_city", S, True), ("seller_state", S, True),
)
ORDER_ITEMS = _schema(
    ("order_id", S, False), ("order_item_id", I, False), ("product_id", S, True), ("seller_id", S, True),
    ("shipping_limit_at", TS, True), ("price", MONEY, True), ("freight_value", MONEY, True),
)
PAYMENTS = _schema(
    ("order_id", S, False), ("payment_sequential", I, False), ("payment_type", S, True),
    ("payment_installments", I, True), ("payment_value", MONEY, True),
)
REVIEWS = _schema(
    ("review_id", S, False), ("order_id", S, False), ("review_score", I, True), ("review_comment_title", S, True),
    ("review_comment_message", S, True), ("review_creation_at", TS, True), ("review_answer_at", TS, True),
)
FACT_ORDERS = _schema(
    *[(f.name, f.dataType, f.nullable) for f in STG_ORDERS.fields],
    ("delivery_days", T.DecimalType(10, 2), True), ("order_item_count", I, False),
    ("distinct_product_count", I, False), ("total_item_value", MONEY, True), ("total_freight_value", MONEY, True),
    ("total_payment_value", MONEY, True), ("avg_review_score", T.DecimalType(3, 2), True), ("review_count", I, False),
)
WATERMARKS = _schema(
    ("pipeline_name", S, False), ("last_order_purchase_timestamp", TS, False), ("last_order_id", S, False),
    ("updated_at", TS, False),
)
BATCH_LOG = _schema(
    ("batch_id", L, False), ("pipeline_name", S, False), ("status", S, False), ("started_at", TS, False),
    ("finished_at", TS, True), ("batch_size", I, False), ("source_min_purchase_ts", TS, True),
    ("source_max_purchase_ts", TS, True), ("source_min_order_id", S, True), ("source_max_order_id", S, True),
    ("staging_orders_loaded", I, True), ("staging_items_loaded", I, True), ("fact_orders_upserted", I, True),
    ("fact_items_upserted", I, True), ("message", S, True),
)
ORDERS_SERVING = _schema(
    ("order_id", S, False), ("customer_id", S, False), ("customer_state", S, True), ("order_status", S, True),
    ("purchased_at", TS, True), ("delivered_at", TS, True), ("items_count", I, True),
    ("total_items_value", MONEY, True), ("total_freight_value", MONEY, True), ("total_payment_value", MONEY, True),
    ("avg_review_score", T.DecimalType(3, 2), True), ("product_categories", S, True),
)


def with_lineage(schema: T.StructType, audit: str) -> T.StructType:
    """Append ``source_batch_id`` and the audit timestamp column."""
    return T.StructType(list(schema.fields) + [
        T.StructField("source_batch_id", L, False), T.StructField(audit, TS, False),
    ])


# Published tables: name -> (schema incl. lineage, key columns).
WAREHOUSE_TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "stg_orders": (with_lineage(STG_ORDERS, "loaded_at"), ["order_id"]),
    "stg_customers": (with_lineage(CUSTOMERS, "loaded_at"), ["customer_id"]),
    "stg_products": (with_lineage(PRODUCTS, "loaded_at"), ["product_id"]),
    "stg_sellers": (with_lineage(SELLERS, "loaded_at"), ["seller_id"]),
    "stg_order_items": (with_lineage(ORDER_ITEMS, "loaded_at"), ["order_id", "order_item_id"]),
    "stg_payments": (with_lineage(PAYMENTS, "loaded_at"), ["order_id", "payment_sequential"]),
    "stg_reviews": (with_lineage(REVIEWS, "loaded_at"), ["review_id", "order_id"]),
    "dim_customer": (with_lineage(CUSTOMERS, "updated_at"), ["customer_id"]),
    "dim_product": (with_lineage(PRODUCTS, "updated_at"), ["product_id"]),
    "dim_seller": (with_lineage(SELLERS, "updated_at"), ["seller_id"]),
    "fact_order_items": (with_lineage(ORDER_ITEMS, "updated_at"), ["order_id", "order_item_id"]),
    "fact_orders": (with_lineage(FACT_ORDERS, "updated_at"), ["order_id"]),
}
STATE_TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "etl_watermarks": (WATERMARKS, ["pipeline_name"]),
    "etl_batch_log": (BATCH_LOG, ["batch_id"]),
}
SERVING_TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "orders": (ORDERS_SERVING, ["order_id"]),
}
# Where the rows of an order lie: every period in which some order-grain table may hold rows of the (cleaned) id.
LOCATOR = "order_locator"
INTERNAL_TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    LOCATOR: (_schema(("order_id", S, False), ("period", S, False)), ["order_id", "period"]),
}
ALL_TABLES = {**WAREHOUSE_TABLES, **STATE_TABLES, **SERVING_TABLES, **INTERNAL_TABLES}


def audit_column(table: str) -> str | None:
    names = ALL_TABLES[table][0].fieldNames()
    for candidate in ("loaded_at", "updated_at"):
        if candidate in names and table in WAREHOUSE_TABLES:
            return candidate
    return None

"""The seven entity cleaners: raw text rows -> typed, keyed staging rows.

Each follows the same order: clean every column, drop rows missing a
required key, then keep the last row per key (orders excepted: they keep
duplicates until the upsert). ``lead`` columns, when given, decide "last"
before the raw columns do (backlog mode leads with the batch number);
``carry`` names raw helper columns passed through unchanged (layout month);
``keep_tiebreak`` leaves the dedupe to the caller, who needs other columns in its key.
Cleaning happens before the key filter and the dedupe, so raw keys that
differ only by surrounding whitespace collapse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_text, to_datetime, to_integer, to_number
from ..operators.keys import ORDER_KEY, ORDINAL, TIEBREAK, dedupe_keep_last, require_keys, tiebreak_of


T_ORDINAL = "_t_ordinal"


def _with_batch(cols: list[Column], batch_id: Column | int | None) -> list[Column]:
    if batch_id is None:
        return cols
    b = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return [*cols, b.cast("long").alias("source_batch_id")]


def _order_id(raw: DataFrame) -> Column:
    return (F.col(ORDER_KEY) if ORDER_KEY in raw.columns else clean_text("order_id")).alias("order_id")


def _finish(df: DataFrame, keys: list[str], dedupe: bool = True) -> DataFrame:
    df = require_keys(df, keys)
    return dedupe_keep_last(df, keys) if dedupe else df


def clean_orders(raw: DataFrame, batch_id: Column | int | None = None, keep_tiebreak: bool = False) -> DataFrame:
    """Orders keep duplicates; ``_tiebreak`` (purchase time, raw id, rest) orders them."""
    purchased = to_datetime("order_purchase_timestamp")
    cols = [
        _order_id(raw),
        clean_text("customer_id").alias("customer_id"),
        clean_text("order_status", "lower").alias("order_status"),
        purchased.alias("purchased_at"),
        to_datetime("order_approved_at").alias("approved_at"),
        to_datetime("order_delivered_carrier_date").alias("delivered_carrier_at"),
        to_datetime("order_delivered_customer_date").alias("delivered_customer_at"),
        to_datetime("order_estimated_delivery_date").alias("estimated_delivery_at"),
    ]
    if keep_tiebreak:
        cols.append(tiebreak_of(raw, ["order_id"], lead=[purchased, F.col("order_id")]).alias(TIEBREAK))
    df = raw.select(*_with_batch(cols, batch_id))
    return _finish(df, ["order_id", "customer_id", "purchased_at"], dedupe=False)


def clean_customers(raw: DataFrame, batch_id: Column | int | None = None, lead: list[Column] = ()) -> DataFrame:
    df = raw.select(*_with_batch([
        clean_text("customer_id").alias("customer_id"),
        clean_text("customer_unique_id").alias("customer_unique_id"),
        to_integer("customer_zip_code_prefix", what="customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        clean_text("customer_city", "lower").alias("customer_city"),
        clean_text("customer_state", "upper").alias("customer_state"),
    ], batch_id), tiebreak_of(raw, ["customer_id"], lead=lead).alias(TIEBREAK))
    return _finish(df, ["customer_id"])


def products_with_translation(products: DataFrame, translations: DataFrame) -> DataFrame:
    """Left join on the raw category text; duplicate translations fan out (deduped later).

    A translation's ordinal, when it has one, comes along as ``_t_ordinal``.
    """
    cols = [F.col("product_category_name").alias("_t_category"), F.col("product_category_name_english")]
    if ORDINAL in translations.columns:
        cols.append(F.col(ORDINAL).alias(T_ORDINAL))
    t = translations.select(*cols)
    joined = products.join(t, products["product_category_name"] == t["_t_category"], "left")
    return joined.drop("_t_category")


def clean_products(products: DataFrame, translations: DataFrame,
                   batch_id: Column | int | None = None, lead: list[Column] = ()) -> DataFrame:
    raw = products_with_translation(products, translations)
    ints = [
        ("product_name_lenght", "product_name_length"),
        ("product_description_lenght", "product_description_length"),
        ("product_photos_qty", "product_photos_qty"),
        ("product_weight_g", "product_weight_g"),
        ("product_length_cm", "product_length_cm"),
        ("product_height_cm", "product_height_cm"),
        ("product_width_cm", "product_width_cm"),
    ]
    df = raw.select(*_with_batch([
        clean_text("product_id").alias("product_id"),
        clean_text("product_category_name", "lower").alias("product_category_name"),
        clean_text("product_category_name_english", "lower").alias("product_category_name_english"),
        *[to_integer(src, what=dst).alias(dst) for src, dst in ints],
    ], batch_id), tiebreak_of(raw, ["product_id"], lead=lead,
                              then=[F.col(c) for c in (T_ORDINAL,) if c in raw.columns]).alias(TIEBREAK))
    return _finish(df, ["product_id"])


def clean_sellers(raw: DataFrame, batch_id: Column | int | None = None, lead: list[Column] = ()) -> DataFrame:
    df = raw.select(*_with_batch([
        clean_text("seller_id").alias("seller_id"),
        to_integer("seller_zip_code_prefix", what="seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        clean_text("seller_city", "lower").alias("seller_city"),
        clean_text("seller_state", "upper").alias("seller_state"),
    ], batch_id), tiebreak_of(raw, ["seller_id"], lead=lead).alias(TIEBREAK))
    return _finish(df, ["seller_id"])


def clean_items(raw: DataFrame, batch_id: Column | int | None = None, lead: list[Column] = (),
                carry: Sequence[str] = (), keep_tiebreak: bool = False) -> DataFrame:
    """Prices stay DECIMAL(18,6) here; they are rounded only when stored."""
    df = raw.select(*_with_batch([
        _order_id(raw),
        to_integer("order_item_id", what="order_item_id").alias("order_item_id"),
        clean_text("product_id").alias("product_id"),
        clean_text("seller_id").alias("seller_id"),
        to_datetime("shipping_limit_date").alias("shipping_limit_at"),
        to_number("price").alias("price"),
        to_number("freight_value").alias("freight_value"),
    ], batch_id), *carry, tiebreak_of(raw, ["order_id", "order_item_id"], lead=lead).alias(TIEBREAK))
    return _finish(df, ["order_id", "order_item_id"], dedupe=not keep_tiebreak)


def clean_payments(raw: DataFrame, batch_id: Column | int | None = None, lead: list[Column] = (),
                   carry: Sequence[str] = (), keep_tiebreak: bool = False) -> DataFrame:
    df = raw.select(*_with_batch([
        _order_id(raw),
        to_integer("payment_sequential", what="payment_sequential").alias("payment_sequential"),
        clean_text("payment_type", "lower").alias("payment_type"),
        to_integer("payment_installments", what="payment_installments").alias("payment_installments"),
        to_number("payment_value").alias("payment_value"),
    ], batch_id), *carry, tiebreak_of(raw, ["order_id", "payment_sequential"], lead=lead).alias(TIEBREAK))
    return _finish(df, ["order_id", "payment_sequential"], dedupe=not keep_tiebreak)


def clean_reviews(raw: DataFrame, batch_id: Column | int | None = None, lead: list[Column] = (),
                  carry: Sequence[str] = (), keep_tiebreak: bool = False) -> DataFrame:
    df = raw.select(*_with_batch([
        clean_text("review_id").alias("review_id"),
        _order_id(raw),
        to_integer("review_score", what="review_score").alias("review_score"),
        clean_text("review_comment_title").alias("review_comment_title"),
        clean_text("review_comment_message").alias("review_comment_message"),
        to_datetime("review_creation_date").alias("review_creation_at"),
        to_datetime("review_answer_timestamp").alias("review_answer_at"),
    ], batch_id), *carry, tiebreak_of(raw, ["review_id", "order_id"], lead=lead).alias(TIEBREAK))
    return _finish(df, ["review_id", "order_id"], dedupe=not keep_tiebreak)

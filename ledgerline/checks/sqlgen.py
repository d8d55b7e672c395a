"""DuckDB-dialect twins of the column functions and cleaners.

Hand-written SQL, independent of the Spark plans, used only as a check.
"""

from __future__ import annotations

from ..sources.binding import raw_ctes

# White space as ranges, written out here on its own.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
EDGE = f"^{SPACE}+|{SPACE}+$"


def strip(c: str) -> str:
    return f"regexp_replace(CAST({c} AS VARCHAR), '{EDGE}', '', 'g')"


def clean_text(c: str, upper: bool = False, lower: bool = False) -> str:
    e = f"NULLIF({strip(c)}, '')"
    if upper:
        e = f"upper({e})"
    if lower:
        e = f"lower({e})"
    return e


def to_datetime(c: str) -> str:
    """A date alone, or the first 26 characters of a date and time whose T becomes a blank."""
    s = strip(c)
    return (f"(CASE WHEN regexp_full_match({s}, '\\d\\d\\d\\d-\\d\\d-\\d\\d') THEN TRY_CAST({s} AS TIMESTAMP) "
            f"WHEN regexp_full_match({s}, '\\d\\d\\d\\d-\\d\\d-\\d\\d[T ]\\d\\d:\\d\\d:\\d\\d([.]\\d+)?') "
            f"THEN TRY_CAST(replace(substr({s}, 1, 26), 'T', ' ') AS TIMESTAMP) END)")


def _double(c: str) -> str:
    return f"TRY_CAST(trim(CAST({c} AS VARCHAR)) AS DOUBLE)"


def to_number(c: str) -> str:
    """The range is judged on the value as a double."""
    d = _double(c)
    return (f"(CASE WHEN {d} IS NULL OR NOT isfinite({d}) THEN NULL WHEN abs({d}) >= 1e12 THEN CAST(error('number out of range') "
            f"AS DECIMAL(18,6)) ELSE TRY_CAST(CAST({c} AS VARCHAR) AS DECIMAL(18,6)) END)")


def to_integer(c: str) -> str:
    d = _double(c)
    return (f"(CASE WHEN {d} IS NULL OR NOT isfinite({d}) THEN NULL WHEN {d} = floor({d}) THEN CAST({d} AS INTEGER) "
            f"ELSE CAST(error('fractional integer') AS INTEGER) END)")


def days_between(later: str, earlier: str) -> str:
    return f"(CAST(date_diff('microsecond', {earlier}, {later}) AS DOUBLE) / 86400000000.0)"


def desc(cols: list[str]) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


# Raw column lists in source order (the keep-last tie-break walks them).
RAW_COLUMNS = {
    "raw_orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                   "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "raw_customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                      "customer_state"],
    "raw_products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                     "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                     "product_width_cm"],
    "raw_translations": ["product_category_name", "product_category_name_english"],
    "raw_sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "raw_order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
                        "freight_value"],
    "raw_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "raw_reviews": ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                    "review_creation_date", "review_answer_timestamp"],
}


def tiebreak(raw_cols: list[str], keys: list[str], lead: list[str] = (), prefix: str = "") -> str:
    others = [c for c in raw_cols if c not in keys]
    return desc([*lead, *[prefix + c for c in [*others, *keys]]])


def cleaned_select(entity: str, src: str = "src", batch: str | None = None, per_batch: bool = False) -> str:
    """SELECT list + FROM + key filter + keep-last for one entity over ``src``.

    ``src`` has the raw columns (for products: the products-translations join).
    ``per_batch``: ``src`` carries ``_batch`` and the keep-last runs per batch.
    """
    b = f", CAST({batch} AS BIGINT) AS source_batch_id" if batch else ""
    if per_batch:
        b += ", _batch"
    if entity == "customers":
        keys = ["customer_id"]
        cols = [f"{clean_text('customer_id')} AS customer_id",
                f"{clean_text('customer_unique_id')} AS customer_unique_id",
                f"{to_integer('customer_zip_code_prefix')} AS customer_zip_code_prefix",
                f"{clean_text('customer_city', lower=True)} AS customer_city",
                f"{clean_text('customer_state', upper=True)} AS customer_state"]
        order = tiebreak(RAW_COLUMNS["raw_customers"], keys)
    elif entity == "products":
        keys = ["product_id"]
        ints = [("product_name_lenght", "product_name_length"),
                ("product_description_lenght", "product_description_length"),
                ("product_photos_qty", "product_photos_qty"), ("product_weight_g", "product_weight_g"),
                ("product_length_cm", "product_length_cm"), ("product_height_cm", "product_height_cm"),
                ("product_width_cm", "product_width_cm")]
        cols = [f"{clean_text('product_id')} AS product_id",
                f"{clean_text('product_category_name', lower=True)} AS product_category_name",
                f"{clean_text('product_category_name_english', lower=True)} AS product_category_name_english",
                *[f"{to_integer(s)} AS {d}" for s, d in ints]]
        order = tiebreak(RAW_COLUMNS["raw_products"] + ["product_category_name_english"], keys)
    elif entity == "sellers":
        keys = ["seller_id"]
        cols = [f"{clean_text('seller_id')} AS seller_id",
                f"{to_integer('seller_zip_code_prefix')} AS seller_zip_code_prefix",
                f"{clean_text('seller_city', lower=True)} AS seller_city",
                f"{clean_text('seller_state', upper=True)} AS seller_state"]
        order = tiebreak(RAW_COLUMNS["raw_sellers"], keys)
    elif entity == "items":
        keys = ["order_id", "order_item_id"]
        cols = [f"{clean_text('order_id')} AS order_id", f"{to_integer('order_item_id')} AS order_item_id",
                f"{clean_text('product_id')} AS product_id", f"{clean_text('seller_id')} AS seller_id",
                f"{to_datetime('shipping_limit_date')} AS shipping_limit_at",
                f"{to_number('price')} AS price", f"{to_number('freight_value')} AS freight_value"]
        order = tiebreak(RAW_COLUMNS["raw_order_items"], keys)
    elif entity == "payments":
        keys = ["order_id", "payment_sequential"]
        cols = [f"{clean_text('order_id')} AS order_id",
                f"{to_integer('payment_sequential')} AS payment_sequential",
                f"{clean_text('payment_type', lower=True)} AS payment_type",
                f"{to_integer('payment_installments')} AS payment_installments",
                f"{to_number('payment_value')} AS payment_value"]
        order = tiebreak(RAW_COLUMNS["raw_payments"], keys)
    elif entity == "reviews":
        keys = ["review_id", "order_id"]
        cols = [f"{clean_text('review_id')} AS review_id", f"{clean_text('order_id')} AS order_id",
                f"{to_integer('review_score')} AS review_score",
                f"{clean_text('review_comment_title')} AS review_comment_title",
                f"{clean_text('review_comment_message')} AS review_comment_message",
                f"{to_datetime('review_creation_date')} AS review_creation_at",
                f"{to_datetime('review_answer_timestamp')} AS review_answer_at"]
        order = tiebreak(RAW_COLUMNS["raw_reviews"], keys)
    else:
        raise KeyError(entity)
    # Clean in an inner query, then filter keys and keep the last row per cleaned key.
    inner_cols = ", ".join(cols)
    raw_keep = ", ".join(f"{c} AS _r_{c}" for c in _raw_cols(entity)) + (", _batch" if per_batch else "")
    part = (["_batch"] if per_batch else []) + keys
    key_filter = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    order_r = ", ".join(f"_r_{part}" for part in order.split(", "))
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT {', '.join(_out_cols(entity))}{b}, row_number() OVER "
            f"(PARTITION BY {', '.join(part)} ORDER BY {order_r}) AS _rn FROM "
            f"(SELECT {inner_cols}, {raw_keep} FROM {src}) c WHERE {key_filter}) d WHERE _rn = 1")


def _raw_cols(entity: str) -> list[str]:
    if entity == "products":
        return RAW_COLUMNS["raw_products"] + ["product_category_name_english"]
    return RAW_COLUMNS["raw_" + {"items": "order_items"}.get(entity, entity)]


def _out_cols(entity: str) -> list[str]:
    from .. import schemas
    s = {"customers": schemas.CUSTOMERS, "products": schemas.PRODUCTS, "sellers": schemas.SELLERS,
         "items": schemas.ORDER_ITEMS, "payments": schemas.PAYMENTS, "reviews": schemas.REVIEWS}[entity]
    return s.fieldNames()


def cleaned_orders(src: str = "raw_orders", batch: str | None = None, per_batch: bool = False) -> str:
    """Cleaned orders over ``src`` with duplicates kept, plus ``_rn_latest`` (1 = latest row).

    ``per_batch``: ``src`` carries ``_batch``; "latest" means latest batch first.
    """
    b = f", CAST({batch} AS BIGINT) AS source_batch_id" if batch else ""
    order = tiebreak(RAW_COLUMNS["raw_orders"], ["order_id"], lead=["_purchased", "order_id"])
    order_r = ", ".join(part if part.startswith("_purchased") else f"_r_{part}" for part in order.split(", "))
    raw_keep = ", ".join(f"{c} AS _r_{c}" for c in RAW_COLUMNS["raw_orders"])
    if per_batch:
        b += ", _batch"
        order_r = "_batch DESC, " + order_r
        raw_keep += ", _batch"
    return f"""SELECT order_id, customer_id, order_status, purchased_at, approved_at, delivered_carrier_at,
       delivered_customer_at, estimated_delivery_at{b},
       row_number() OVER (PARTITION BY order_id ORDER BY {order_r}) AS _rn_latest
FROM (SELECT {clean_text('order_id')} AS order_id, {clean_text('customer_id')} AS customer_id,
             {clean_text('order_status', lower=True)} AS order_status,
             {to_datetime('order_purchase_timestamp')} AS purchased_at,
             {to_datetime('order_purchase_timestamp')} AS _purchased,
             {to_datetime('order_approved_at')} AS approved_at,
             {to_datetime('order_delivered_carrier_date')} AS delivered_carrier_at,
             {to_datetime('order_delivered_customer_date')} AS delivered_customer_at,
             {to_datetime('order_estimated_delivery_date')} AS estimated_delivery_at, {raw_keep}
      FROM {src}) c
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND purchased_at IS NOT NULL"""


def with_raw(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the raw binding CTEs (and optional extra CTEs)."""
    head = raw_ctes()
    if extra_ctes:
        head += ",\n" + extra_ctes
    return f"{head}\n{body}"

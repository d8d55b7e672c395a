from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="ledgerline-tests", shuffle_partitions=4, extra_conf={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-ckpt-"))
    s.conf.set("spark.ledgerline.reuseLoads", "true")
    yield s
    s.stop()


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


@pytest.fixture
def make_raw(spark):
    """Build the eight raw text tables from partial dict rows (missing cells are NULL)."""

    def _make(**tables):
        out = {}
        for name, cols in RAW_COLUMNS.items():
            short = name.removeprefix("raw_")
            rows = tables.get("items" if short == "order_items" else short, [])
            data = [tuple(r.get(c) for c in cols) for r in rows]
            out[name] = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
        return out

    return _make


@pytest.fixture
def store_root(spark):
    from ledgerline.session import scratch_path
    return scratch_path(spark, "test-wh")

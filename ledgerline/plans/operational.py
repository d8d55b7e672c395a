"""Operational and validation queries over the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_LISTING_COLUMNS = ["batch_id", "status", "batch_size", "staging_orders_loaded", "fact_orders_upserted",
                       "source_min_purchase_ts", "source_max_purchase_ts"]


def log_listing(log: DataFrame) -> DataFrame:
    """The batch log in batch order (seven columns)."""
    return log.select(*LOG_LISTING_COLUMNS).orderBy("batch_id")


def log_latest(log: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` batches."""
    return log.select(*LOG_LISTING_COLUMNS).orderBy(F.col("batch_id").desc()).limit(n)


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(layer_table, row_count)`` for each given table, as one union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
        F.lit(name).alias("layer_table"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows under a stable order."""
    return df.orderBy(*order_by).limit(n)


def late_rows(clean_orders: DataFrame, stg_orders: DataFrame, wm_ts, wm_id) -> DataFrame:
    """Valid orders at or below the watermark that never reached staging (they stay out until a refresh)."""
    ts = F.lit(wm_ts).cast("timestamp_ntz")
    at_or_below = (F.col("purchased_at") < ts) | ((F.col("purchased_at") == ts) & (F.col("order_id") <= F.lit(wm_id)))
    return clean_orders.where(at_or_below).join(stg_orders.select("order_id"), "order_id", "left_anti")

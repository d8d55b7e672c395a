"""Pipeline state: the keyset watermark and the batch log (tiny tables)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import truncate
from ..operators.upsert import upsert

PIPELINE_NAME = "orders_warehouse_incremental"
# The watermark before the first batch.
DEFAULT_WATERMARK = (dt.datetime(1900, 1, 1), "")
MESSAGE_LIMIT = 1000


def now_ntz() -> F.Column:
    return F.current_timestamp().cast("timestamp_ntz")


def watermark_row(watermarks: DataFrame, pipeline: str = PIPELINE_NAME) -> DataFrame:
    """One row ``(last_order_purchase_timestamp, last_order_id)``, defaulted when absent."""
    w = watermarks.where(F.col("pipeline_name") == F.lit(pipeline))
    return w.agg(
        F.coalesce(F.max("last_order_purchase_timestamp"),
                   F.lit(DEFAULT_WATERMARK[0]).cast("timestamp_ntz")).alias("last_order_purchase_timestamp"),
        F.coalesce(F.max("last_order_id"), F.lit(DEFAULT_WATERMARK[1])).alias("last_order_id"),
    )


def get_watermark(watermarks: DataFrame, pipeline: str = PIPELINE_NAME) -> tuple[dt.datetime, str]:
    r = watermark_row(watermarks, pipeline).first()
    return r.last_order_purchase_timestamp, r.last_order_id


def advance_watermark(spark: SparkSession, watermarks: DataFrame, ts: dt.datetime, order_id: str,
                      pipeline: str = PIPELINE_NAME) -> DataFrame:
    """Upsert the pipeline's row; ``updated_at`` is refreshed on every advance."""
    new = spark.createDataFrame([(pipeline, ts, order_id)],
                                "pipeline_name string, last_order_purchase_timestamp timestamp_ntz, last_order_id string")
    new = new.withColumn("updated_at", now_ntz())
    return upsert(watermarks, new, ["pipeline_name"])


def next_batch_id(log: DataFrame) -> int:
    return int(log.agg(F.coalesce(F.max("batch_id"), F.lit(0))).first()[0]) + 1


def log_started(spark: SparkSession, log: DataFrame, batch_id: int, bounds: DataFrame,
                pipeline: str = PIPELINE_NAME) -> DataFrame:
    """Append a ``running`` row built from the batch bounds (a one-row DataFrame)."""
    row = bounds.select(
        F.lit(batch_id).cast("long").alias("batch_id"), F.lit(pipeline).alias("pipeline_name"),
        F.lit("running").alias("status"), now_ntz().alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("finished_at"), "batch_size",
        "source_min_purchase_ts", "source_max_purchase_ts", "source_min_order_id", "source_max_order_id",
        *[F.lit(0).cast("int").alias(c) for c in
          ("staging_orders_loaded", "staging_items_loaded", "fact_orders_upserted", "fact_items_upserted")],
        F.lit("Batch started").alias("message"),
    )
    return log.unionByName(row)


def log_finished(log: DataFrame, batch_id: int, metrics: tuple[int, int, int, int] | None = None,
                 error: str | None = None) -> DataFrame:
    """Close the batch's row as ``completed`` with its four metrics, or ``failed`` with a message."""
    hit = F.col("batch_id") == F.lit(batch_id)
    cols = []
    for f in schemas.BATCH_LOG.fields:
        c = f.name
        if c == "status":
            v = F.lit("failed" if error is not None else "completed")
        elif c == "finished_at":
            v = now_ntz()
        elif c == "message":
            v = truncate(F.lit(error), MESSAGE_LIMIT) if error is not None else F.lit("Batch completed")
        elif metrics is not None and c in ("staging_orders_loaded", "staging_items_loaded",
                                           "fact_orders_upserted", "fact_items_upserted"):
            idx = ("staging_orders_loaded", "staging_items_loaded", "fact_orders_upserted",
                   "fact_items_upserted").index(c)
            v = F.lit(int(metrics[idx])).cast("int")
        else:
            cols.append(F.col(c))
            continue
        cols.append(F.when(hit, v).otherwise(F.col(c)).cast(f.dataType).alias(c))
    return log.select(*cols)

"""Publishing the serving table: constraint check, then one atomic full replace."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from .. import schemas
from .serving import build_orders_serving
from .store import ConstraintViolation, constraint_report, refuse

__all__ = ["ConstraintViolation", "publish_orders_serving"]


def publish_orders_serving(store, raw: dict[str, DataFrame]) -> int:
    """Rebuild ``orders`` and replace it in one manifest swap; refuse on violations.

    The source system's full reload fails as a whole on a NOT NULL or key
    violation; here the report (one row per violated constraint, so at most a
    handful of rows reach the driver) is checked before anything is written.
    The frame is computed once, for the report and the write.
    """
    schema, keys = schemas.SERVING_TABLES["orders"]
    df = build_orders_serving(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        refuse(constraint_report(df, "orders", schema, keys), "orders")
        return store.publish({"orders": df})
    finally:
        df.unpersist()

"""Distributed global row numbering under a sort order.

A ``row_number()`` window without ``partitionBy`` moves every row into one
task. Instead: range-partition and sort, tag each row with its partition and
a within-partition position, checkpoint or write (``keep``, so the positions never
change on recomputation), count rows per partition, turn the counts into offsets, and
add. Only one row per partition reaches the offsets step, which is why its
broadcast has a proven size bound (the partition count).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "rank",
                      num_partitions: int | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df.checkpoint()) -> DataFrame:
    parts = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = (parts.sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = keep(tagged)
    per_part = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = per_part.select(
        "_pid", "_first",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"),
    )
    ranked = tagged.join(F.broadcast(offsets), "_pid")
    return ranked.withColumn(out, F.col("_offset") + (F.col("_mid") - F.col("_first")) + F.lit(1)).drop(
        "_pid", "_mid", "_first", "_offset")

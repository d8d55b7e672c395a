"""Projected and parameterised reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table with an optional column list (pruned at the scan)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def param_query(spark: SparkSession, query: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with named ``:markers`` bound from ``args`` and ``{name}`` frames."""
    return spark.sql(query, args=args or {}, **frames)

"""Store-time typing and constraint checks (what the table DDL enforced)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import strict_cast


def store_cast(df: DataFrame, field: T.StructField):
    """One column as stored: numeric narrowing rounds HALF_UP and fails on overflow."""
    current = df.schema[field.name].dataType
    if current == field.dataType:
        return F.col(field.name)
    if isinstance(field.dataType, (T.DecimalType, T.IntegerType, T.LongType)):
        return strict_cast(F.col(field.name), field.dataType, field.name).alias(field.name)
    return F.col(field.name).cast(field.dataType).alias(field.name)


def not_null(field: T.StructField, table: str):
    """The stored column; a NULL in a NOT NULL column fails the write."""
    col = F.col(field.name).cast(field.dataType)
    if field.nullable:
        return col.alias(field.name)
    message = F.lit(f"null value in column {field.name} of {table}")
    return F.coalesce(col, F.raise_error(message).cast(field.dataType)).alias(field.name)


def repeated_keys(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """(table_name, constraint_name, violations): rows beyond the first of their key, if there are any."""
    return (df.groupBy(*keys).count().where(F.col("count") > 1)
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("violations"))
            .select(F.lit(table).alias("table_name"), F.lit("primary_key:" + ",".join(keys)).alias("constraint_name"), "violations")
            .where(F.col("violations") > 0))


class ConstraintViolation(ValueError):
    pass


def refuse(report: DataFrame, what: str) -> None:
    """Raise if a constraint report (one row per violated constraint) has rows."""
    refuse_found(report.collect(), what)


def refuse_found(found: Sequence[Row], what: str) -> None:
    """:func:`refuse` for the rows of collected reports."""
    if found:
        detail = ", ".join(f"{r.table_name} {r.constraint_name}={r.violations}" for r in found)
        raise ConstraintViolation(f"{what} not published: {detail}")


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to ``schema``: decimals round HALF_UP, overflow raises."""
    return df.select(*[store_cast(df, f) for f in schema.fields])


def typed(df: DataFrame, schema: T.StructType, lineage: Sequence[str] = ("source_batch_id",)) -> DataFrame:
    """:func:`cast_to` plus whichever lineage columns ``df`` carries."""
    extra = [F.col(c) for c in lineage if c in df.columns]
    return df.select(*[store_cast(df, f) for f in schema.fields], *extra)


def constraint_report(df: DataFrame, table: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """One row per violated constraint: ``(table_name, constraint_name, violations)``.

    Checks every NOT NULL column and key uniqueness in a single pass plus one
    aggregate on the key; an empty result means the table may be published.
    """
    required = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    repeated = repeated_keys(df, table, keys)
    if not required:
        return repeated
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in required])
    stack = ", ".join(f"'not_null:{c}', `{c}`" for c in required)
    nulls = (counts.selectExpr(f"stack({len(required)}, {stack}) AS (constraint_name, violations)").where(F.col("violations") > 0)
             .select(F.lit(table).alias("table_name"), "constraint_name", F.col("violations").cast("long").alias("violations")))
    return nulls.unionByName(repeated)

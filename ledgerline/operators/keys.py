"""Key handling: required keys, keep-last dedupe, distinct key lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDINAL = "_ordinal"   # a row's place in its CSV table: file, block, row
ORDER_KEY = "_order_key"  # a raw row's cleaned order id, where it was needed before the row was cleaned
TIEBREAK = "_tiebreak"  # struct that orders duplicate rows: greatest = last


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows where any key column is NULL."""
    return df.na.drop("any", subset=list(keys))


def tiebreak_of(raw: DataFrame, key_columns: Sequence[str], lead: Sequence[Column] = (),
                then: Sequence[Column] = ()) -> Column:
    """The ordering that decides which duplicate is "last".

    ``lead`` columns come first. With a source ordinal (CSV ingest) the last row read wins, and of rows
    that a join made from it the greatest by ``then`` (the other side's ordinal). Every non-key raw column
    and the raw key columns follow, compared descending with NULL lowest, so rows that still tie are
    equal and the pick does not depend on the plan. Helper columns (leading ``_``) are skipped there.
    """
    others = [c for c in raw.columns if c not in key_columns and not c.startswith("_")]
    source = [F.col(ORDINAL)] if ORDINAL in raw.columns else []
    fields = [*lead, *source, *then, *[F.col(c) for c in [*others, *key_columns]]]
    return F.struct(*[c.alias(f"t{i}") for i, c in enumerate(fields)])  # a column may lead and come again: names must differ to be stored


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], order_col: str = TIEBREAK, drop: bool = True) -> DataFrame:
    """One row per key: the greatest by ``order_col`` (NULL fields lowest); ``order_col`` is dropped unless told not to.

    ``row_number() = 1`` over the key: Spark plans it with a partial
    ``WindowGroupLimit`` that keeps the top row per key in every map task
    before the shuffle, so a hot key is reduced map-side instead of landing in
    one task whole. ``tiebreak_of`` leaves only equal rows tied, so the pick is
    deterministic.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
    return (df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .drop("_rn", *([order_col] if drop else [])))


def distinct_keys(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Distinct non-null values of one column (the reference's id lists)."""
    return df.where(F.col(column).isNotNull()).select(F.col(column).alias(alias or column)).distinct()

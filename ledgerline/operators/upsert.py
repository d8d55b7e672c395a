"""Keyed upsert and insert-if-absent as DataFrame plans.

Both produce the full new version of the target; publishing it is the job of
:mod:`ledgerline.streaming.publish`. ``new`` must be unique on ``keys``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str], audit: str | None = None,
           now: Column | None = None, new_bounded: bool = False) -> DataFrame:
    """Insert new keys; for existing keys overwrite every non-key column of ``new``.

    Columns of ``target`` that ``new`` lacks keep their stored value; the audit
    column keeps its first-insert time and is set to ``now`` on insert.

    Unbounded ``new``: one full outer join on the key; each key is unique on
    both sides, so the join is 1:1 and cannot fan out or skew.
    Bounded ``new`` (a batch of at most the batch maximum): the target is never
    shuffled -- it streams through a broadcast anti join against the new keys,
    and only the few matched rows' audit values meet the new rows.
    """
    keys = list(keys)
    now = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    if new_bounded:
        return _upsert_bounded(target, new, keys, audit, now)
    new_cols = [c for c in new.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in new_cols], F.lit(True).alias("_n_present"))
    joined = target.join(n, keys, "full_outer")
    out = []
    for field in target.schema.fields:
        c = field.name
        if c in keys:
            out.append(F.col(c))
        elif c == audit:
            out.append(F.coalesce(F.col(c), now).cast(field.dataType).alias(c))
        elif c in new_cols:
            out.append(F.when(F.col("_n_present"), F.col(f"_n_{c}")).otherwise(F.col(c)).cast(field.dataType).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def first_rows(target: DataFrame, new: DataFrame, audit: str | None = None, now: Column | None = None) -> DataFrame:
    """What :func:`upsert` gives where ``target`` is known to hold no rows: ``new`` as stored, without meeting it by key."""
    now = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    values = {f.name: now if f.name == audit else F.col(f.name) if f.name in new.columns else F.lit(None) for f in target.schema.fields}
    return new.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in target.schema.fields])


def insert_absent(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert rows whose key is not yet present; existing rows are untouched."""
    fresh = new.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def _upsert_bounded(target: DataFrame, new: DataFrame, keys: list[str], audit: str | None,
                    now: Column) -> DataFrame:
    new_keys = F.broadcast(new.select(*keys))
    kept = target.join(new_keys, keys, "left_anti")
    # Stored values the new rows carry over: the audit time, and columns they do not set.
    carried = [c for c in target.columns if c not in keys and (c == audit or c not in new.columns)]
    if carried:
        prior = target.select(*keys, *carried).join(new_keys, keys, "left_semi")  # at most |new| rows
        new = new.drop(*[c for c in carried if c in new.columns]).join(F.broadcast(prior), keys, "left")
    cols = [(F.coalesce(F.col(f.name), now) if f.name == audit else F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields]
    return kept.unionByName(new.select(*cols))

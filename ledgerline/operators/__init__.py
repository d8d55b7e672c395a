"""Relational building blocks shared by the entity, fact and pipeline plans."""

from .bounds import batch_bounds
from .closure import Closure, batch_closure, semi_by
from .keys import ORDINAL, TIEBREAK, dedupe_keep_last, distinct_keys, require_keys, tiebreak_of
from .upsert import insert_absent, upsert

__all__ = [
    "Closure", "ORDINAL", "TIEBREAK", "batch_bounds", "batch_closure", "dedupe_keep_last",
    "distinct_keys", "insert_absent", "require_keys", "semi_by", "tiebreak_of", "upsert",
]

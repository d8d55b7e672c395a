"""Column expressions made once."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column

_MADE: dict[tuple, Column] = {}


def made_once(function: Callable[..., Column]) -> Callable[..., Column]:
    """A function of a column that gives its expression of a column *name* again instead of making it anew.

    An expression is a tree of unresolved names, the same for every frame. Each of its nodes is a call (more, as Spark notes where
    it was made) from Python to the driver's JVM; the batch loop asks for the same hundreds in every batch.
    """
    @wraps(function)
    def made(col: Column | str, *args, **named) -> Column:
        if not isinstance(col, str):
            return function(col, *args, **named)
        key = (id(SparkContext._gateway), function, col, args, tuple(sorted(named.items())))
        if key not in _MADE:
            _MADE[key] = function(col, *args, **named)
        return _MADE[key]

    return made

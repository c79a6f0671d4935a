"""Small helpers for building column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    """A column of a name, a column or a number."""
    if isinstance(x, str):
        return F.col(x)
    return x if isinstance(x, Column) else F.lit(x)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))

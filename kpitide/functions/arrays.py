"""Element-wise array expressions that cut to the shorter input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shorter(a: Column, b: Column) -> Column:
    return F.least(F.size(a), F.size(b))


def zip_short(a: Column, b: Column) -> Column:
    """Pairs ``(left, right)``; ``arrays_zip`` would pad the shorter array with NULL."""
    n = _shorter(a, b)
    return F.zip_with(
        F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: F.struct(x.alias("left"), y.alias("right"))
    )


def add_short(a: Column, b: Column) -> Column:
    """Element-wise sum."""
    n = _shorter(a, b)
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x + y)

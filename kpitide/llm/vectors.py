"""What the vector operators share: which vectors take part, and their columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, key: str, vector: str, *others: str) -> tuple[DataFrame, int]:
    """``id, vec`` and other columns of the rows that take part, and the number of components.

    Left out are rows with a null id or vector, vectors that are zero or hold null or non-finite components, and
    vectors that have not the number of components that most have (the larger number if as many have another).
    """
    column = F.col(vector)
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(column, lambda x: x != 0)
    fine = df.where(F.col(key).isNotNull() & column.isNotNull()).where(~bad & ~zero)
    sizes = fine.groupBy(F.size(column).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return fine.select(F.col(key).alias("id"), column.alias("vec"), *others), 0
    dim = sizes[0]["size"]
    return fine.where(F.size(column) == dim).select(F.col(key).alias("id"), column.alias("vec"), *others), dim


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column without nulls as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def sample(points: DataFrame, at_most: int) -> DataFrame:
    """About ``at_most`` rows at most, chosen by the hash of the id."""
    n = points.count()
    if n <= at_most:
        return points
    share = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000))
    return points.where(share < int(0.97e6 * at_most / n))

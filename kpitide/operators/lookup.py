"""Dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpitide.schemas import provinces


def with_province_name(df: DataFrame, dimension: DataFrame | None = None, code: str = "province_code") -> DataFrame:
    """Add ``province``: the name of the code, or the code itself where the dimension has none.

    The built-in dimension is 31 rows and is broadcast. For another one, with a row per ``code`` and
    its ``name``, the optimizer chooses the join by its size.
    """
    dim = F.broadcast(provinces(df.sparkSession)) if dimension is None else dimension
    dim = dim.select(F.col("code").alias("_code"), F.col("name").alias("_name"))
    joined = df.join(dim, F.col(code) == F.col("_code"), "left")
    return joined.withColumn("province", F.coalesce("_name", code)).drop("_code", "_name")

"""Element-wise sums of array columns by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_sum(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Sum the vectors of each key slot by slot, cut to the key's shortest vector.

    Slots are summed by key and position, so a key with many rows is combined on the map side and
    no task holds more of it than one sum per slot.
    """
    slots = df.select(key, F.posexplode_outer(vector).alias("_pos", "_x"))
    sums = slots.groupBy(key, "_pos").agg(F.sum("_x").alias("_s"), F.count(F.lit(1)).alias("_n"))
    by_key = sums.groupBy(key).agg(
        F.array_sort(
            F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_s", "_n")))
        ).alias("_slots"),
        # Position 0 is in every vector but the empty ones, which have the NULL position.
        F.sum(F.when(F.col("_pos").isNull() | (F.col("_pos") == 0), F.col("_n"))).alias("_rows"),
    )
    full = F.filter("_slots", lambda s: s["_n"] == F.col("_rows"))
    return by_key.select(key, F.transform(full, lambda s: s["_s"]).alias("sums"))

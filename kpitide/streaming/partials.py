"""Sums that survive replays: each micro-batch overwrites its own folder of partial sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpitide.operators.keyed import held_cells
from kpitide.streaming.store import BatchStore


class PartialSums(BatchStore):
    """Partial sums of a keyed table: what a key's rows come to is their sum."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        expiry_keys: Sequence[str] = (),
        ttl: int | None = None,
    ):
        """``ttl`` is the number of seconds after which the sums of an ``expiry_keys`` value are lost without a write."""
        super().__init__(spark, path, schema, keys)
        self.expiry_keys = list(expiry_keys)
        self.ttl = ttl

    def _fold(self, entries: DataFrame, *extra: Column) -> DataFrame:
        sums = [F.sum(name).cast(kind).alias(name) for name, kind in self.types.items()]
        return entries.groupBy(*self.keys, *extra).agg(*sums)

    def _held(self, entries: DataFrame) -> DataFrame:
        return entries if self.ttl is None else held_cells(entries, self.expiry_keys, self.ttl)

    def _merged(self, entries: DataFrame) -> DataFrame:
        """Sums by key. With a ``ttl`` each key keeps the time of its last write, and what it has lost is left out."""
        held = self._held(entries)
        if self.ttl is None:
            return self._fold(held).withColumn("write_time", F.lit(None))
        last_write = F.col("expires_at") - F.make_dt_interval(secs=F.lit(self.ttl))
        return self._fold(held, last_write.alias("write_time"))

    def totals(self, before: int | None = None) -> DataFrame:
        """Cumulative sums; with a ``ttl``, since each key last began."""
        return self._fold(self._held(self.entries(before)))

    def of_keys(self, key: str, values: Sequence[str]) -> DataFrame:
        """Cumulative sums of a few values of a key column; the others are left out before the sum."""
        return self._fold(self._held(self.entries().where(F.col(key).isin(list(values)))))

    def live(self, as_of: Column) -> DataFrame:
        """Cumulative sums of the keys that have not expired at ``as_of``."""
        return self._fold(self._held(self.entries()).where(F.col("expires_at") > as_of))

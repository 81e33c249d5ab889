"""Values that a later write replaces: of each key the rows of the newest micro-batch that wrote it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpitide.streaming.store import BatchStore

VERSION = ["in_run", "in_batch"]


class LatestRows(BatchStore):
    """A keyed table of which the last write wins. Rows keep the run and the batch that wrote them, so a base merges with newer ones in any order.

    Each micro-batch writes a key at most once. With a ``ttl``, in seconds, a key is gone that long after its last write.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], ttl: int | None = None):
        versioned = T.StructType([*schema.fields, *[T.StructField(v, T.LongType()) for v in VERSION]])
        super().__init__(spark, path, versioned, keys)
        self.ttl = ttl

    def put(self, rows: DataFrame, batch_id: int, write_time: Column | None = None) -> None:
        marked = rows.withColumns({"in_run": F.lit(self.run), "in_batch": F.lit(batch_id)})
        super().put(marked, batch_id, write_time)

    def _merged(self, entries: DataFrame) -> DataFrame:
        rest = [f.name for f in self.schema.fields if f.name not in self.keys]
        newest = F.max_by(F.struct(*rest), F.struct(*VERSION)).alias("_newest")
        return entries.groupBy(*self.keys).agg(newest).select(*self.keys, "_newest.*")

    def rows(self, before: int | None = None) -> DataFrame:
        """What the last writes have left, with ``in_run`` and ``in_batch``."""
        return self._merged(self.entries(before)).drop("write_time")

    def newest_run(self) -> int:
        """The newest run that has stored anything."""
        runs = [int(r.removeprefix("run=")) for r in self.folders.names("batches") if self.folders.names(f"batches/{r}")]
        return max([self._base_version()[0], *runs])

    def live(self, as_of: Column) -> DataFrame:
        """The rows of keys that have not expired at ``as_of``."""
        held = self._merged(self.entries())
        if self.ttl is not None:
            held = held.where(F.col("write_time") + F.make_dt_interval(secs=F.lit(self.ttl)) > as_of)
        return held.drop("write_time")

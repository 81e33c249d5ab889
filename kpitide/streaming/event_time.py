"""Windows that close: sums by tumbling window, each given out once, when the watermark has passed its end.

Orders that come after their window has closed do not change it. They go into a side output, summed by window, with their number. A
window that is still open lies in the state. So closed windows, late orders and open windows together are all orders.

A window is one key of the state, with a timer at its end. It meets one row per window, task and batch of rows, not one per order.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from kpitide import schemas as S
from kpitide.functions import times
from kpitide.operators.project import base_rows
from kpitide.streaming import jobs
from kpitide.streaming.partials import PartialSums
from kpitide.streaming.state import combined, rocks, state_of

CLOSED, LATE = "closed", "late"
SUMS = "sums"
_SUMS = T.StructType([f for f in jobs.WINDOW_SUMS.fields if f.name not in jobs.WINDOW_KEYS])
_OUT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("window_ms", T.LongType()), *_SUMS.fields])
STORED = T.StructType([T.StructField("kind", T.StringType()), *jobs.WINDOW_SUMS.fields])
ZERO = Row(orders=0, succ=0, fee=Decimal("0.00"))


class ClosingWindows(StatefulProcessor):
    """Sums of a window until its end has passed. The key is the window's start in milliseconds."""

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState(SUMS, _SUMS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        orders, succ, fee = ZERO
        for r in rows:
            orders, succ, fee = orders + r["orders"], succ + r["succ"], fee + r["fee"]
        end = key[0] + self.width_ms
        if timerValues.getCurrentWatermarkInMs() >= end:
            yield Row(kind=LATE, window_ms=key[0], orders=orders, succ=succ, fee=fee)
            return
        if self.sums.exists():
            before = self.sums.get()
            orders, succ, fee = orders + before[0], succ + before[1], fee + before[2]
        else:
            self.handle.registerTimer(end)
        self.sums.update((orders, succ, fee))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        orders, succ, fee = self.sums.get()
        self.sums.clear()
        yield Row(kind=CLOSED, window_ms=key[0], orders=orders, succ=succ, fee=fee)

    def close(self) -> None:
        pass


def window_store(spark: SparkSession, path: str) -> PartialSums:
    """Closed windows, one row each, and late orders by window."""
    return PartialSums(spark, path, STORED, ["kind", *jobs.WINDOW_KEYS]).create()


def _bounds(rows: DataFrame, width_ms: int) -> DataFrame:
    start, end = times.utc_timestamp(F.col("window_ms")), times.utc_timestamp(F.col("window_ms") + width_ms)
    return rows.withColumns({"window_start": start, "window_end": end}).drop("window_ms")


def closing_window_stream(
    log: DataFrame,
    store: PartialSums,
    checkpoint: str,
    width_ms: int = 60_000,
    delay: str = "10 minutes",
    every: str | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Closed windows and late orders into the store. ``delay``: how far the watermark stays behind the latest order."""
    millis = times.utc_millis(F.col("start_ts"))
    stamped = base_rows(log).withColumn("_millis", millis).withColumn("_at", F.timestamp_millis("_millis")).withWatermark("_at", delay)
    window = (F.floor(F.col("_millis") / width_ms) * width_ms).cast("bigint").alias("window_ms")
    sums = stamped.select(window, "orders", "succ", F.col("fee").cast(S.MONEY_SUM).alias("fee"))
    few = combined(sums, ["window_ms"], ["orders", "succ", "fee"])
    windows = few.groupBy("window_ms").transformWithState(ClosingWindows(width_ms), _OUT, "append", "EventTime")
    store.begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        store.put(_bounds(batch, width_ms), batch_id)
        store.after_batch(batch_id, compact_every)

    with rocks(log.sparkSession):
        return jobs.start(windows.writeStream.outputMode("append").foreachBatch(put), checkpoint, every)


def closed_windows(store: PartialSums) -> DataFrame:
    return store.totals().where(F.col("kind") == CLOSED).drop("kind")


def late_orders(store: PartialSums) -> DataFrame:
    """Orders that came after their window had closed, summed by window; ``orders`` is their number."""
    return store.totals().where(F.col("kind") == LATE).drop("kind")


def open_windows(spark: SparkSession, checkpoint: str, width_ms: int = 60_000) -> DataFrame:
    """Windows that the watermark has not passed yet, from the state."""
    return _bounds(state_of(spark, checkpoint, SUMS), width_ms).select(*jobs.WINDOW_SUMS.names)


def all_windows(store: PartialSums, checkpoint: str, width_ms: int = 60_000) -> DataFrame:
    """Sums by window of all orders so far: closed, late and open."""
    parts = [closed_windows(store), late_orders(store), open_windows(store.spark, checkpoint, width_ms)]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy(*jobs.WINDOW_KEYS).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in _SUMS.fields])

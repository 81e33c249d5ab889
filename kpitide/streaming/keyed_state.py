"""Counts and sums kept per key in Spark's own state: a running count per token, counts that start from a seed, and sums that expire.

No job sends a row per record to the state. Records are combined by key and task first, or by key and block where each record
needs its own number: the state then gives each block the count it starts from, and records are numbered within blocks outside of it.
Counts of tokens are kept by bucket of tokens, as each access to the state from Python takes about as long as a thousand tokens do.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from kpitide import schemas as S
from kpitide.functions import times
from kpitide.operators import words
from kpitide.session import scratch_path
from kpitide.sources.folders import Folders
from kpitide.streaming import jobs
from kpitide.streaming.latest import LatestRows
from kpitide.streaming.state import combined, rocks
from kpitide.streaming.store import run_number

TOTAL = "total"


class WordTotals(StatefulProcessor):
    """The counts of the words of a bucket. Takes ``word, batch, block, n`` and gives, for each row, the count of its word before it and with it.

    Rows of a word are taken by batch and block, whatever order they come in. The state is read and written once for all words of the bucket.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState(TOTAL, "words array<string>, counts array<bigint>")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.totals.update((list(initialState["words"]), list(initialState["counts"])))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.totals.get()
        totals = {} if held is None else dict(zip(*held, strict=True))
        for r in sorted(rows, key=lambda r: (r["batch"], r["block"])):
            word = r["word"]
            before = totals.get(word, 0)
            totals[word] = n = before + r["n"]
            yield Row(word=word, batch=r["batch"], block=r["block"], before=before, n=n)
        self.totals.update((list(totals), list(totals.values())))

    def close(self) -> None:
        pass


TOTALS = "word string, batch bigint, block int, before bigint, n bigint"
BUCKETS = 4096  # the keys of the state: a checkpoint goes on with the number it began with


def bucketed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int"))


def word_totals(counts: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """The counts ``word, batch, block, n`` through the state. A seed ``word, n0`` is taken in once, before the first batch of a checkpoint."""
    start = None
    if seed is not None:
        pairs = F.collect_list(F.struct("word", "n0")).alias("pairs")
        of_bucket = bucketed(seed.select("word", "n0")).groupBy("bucket").agg(pairs)
        of_bucket = of_bucket.select("bucket", F.col("pairs.word").alias("words"), F.col("pairs.n0").alias("counts"))
        start = jobs.stored_seed(of_bucket).groupBy("bucket")
    return bucketed(counts).groupBy("bucket").transformWithState(WordTotals(), TOTALS, "update", "None", start)


def seeded_state_stream(
    lines: DataFrame,
    seed: DataFrame,
    latest: LatestRows,
    checkpoint: str,
    delimiter: str = " ",
    every: str | None = None,
    compact_every: int | None = 50,
) -> StreamingQuery:
    """Count, on top of the seed, of each word that came; the store has a word's newest count."""
    tokens = words.tokenize(lines, delimiter=delimiter).select("word", F.lit(0).cast("bigint").alias("batch"), F.lit(0).alias("block"), F.lit(1).cast("bigint").alias("n"))
    totals = word_totals(combined(tokens, ["word", "batch", "block"], ["n"]), seed)
    latest.begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        latest.put(batch.groupBy("word").agg(F.max("n").alias("n")), batch_id)
        latest.after_batch(batch_id, compact_every)

    with rocks(lines.sparkSession):
        return jobs.start(totals.writeStream.outputMode("update").foreachBatch(put), checkpoint, every)


TOKEN, COUNT = "token", "count"


def numbered_stream(
    lines: DataFrame, keys: Sequence[str], path: str, checkpoint: str, delimiter: str = " ", every: str | None = None
) -> StreamingQuery:
    """First half of a running count: the tokens of each micro-batch in blocks by range of the keys, each numbered within word and block, and beside them the
    counts by word and block.

    It keeps no state. Spark's file sink makes each micro-batch appear as a whole and once. ``batch`` is the micro-batch's time, by which later ones are larger.
    """
    now = F.unix_millis(F.current_timestamp()).alias("batch")
    ranged = lines.repartitionByRange(*keys).select(*keys, "value", now, F.spark_partition_id().alias("block"))
    tokens = words.tokenize(ranged, *keys, "batch", "block", delimiter=delimiter)
    order = [*keys, "pos"]
    names = [*tokens.columns, "n", "kind"]
    # A row of counts has no keys.
    fields = [T.StructField(f.name, f.dataType) for f in tokens.schema.fields]
    schema = T.StructType([*fields, T.StructField("n", T.LongType()), T.StructField("kind", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by([(k, "ascending") for k in order])
        seen: Counter[str] = Counter()
        for b in table.to_batches(max_chunksize=10_000):
            numbers = np.empty(b.num_rows, np.int64)
            for i, word in enumerate(b.column("word").to_pylist()):
                seen[word] += 1
                numbers[i] = seen[word]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers), pa.array([TOKEN] * b.num_rows)], names=names)
        first = table.slice(0, 1).to_batches()[0]
        found, counts = list(seen), pa.array(list(seen.values()), pa.int64())
        for lo in range(0, len(found), 10_000):
            some = pa.array(found[lo : lo + 10_000], pa.string())
            columns = []
            for name, column in zip(first.schema.names, first.columns, strict=True):
                shared = name in ("batch", "block")
                columns.append(some if name == "word" else pa.array([column[0].as_py() if shared else None] * len(some), column.type))
            yield pa.RecordBatch.from_arrays([*columns, counts.slice(lo, len(some)), pa.array([COUNT] * len(some))], names=names)

    out = tokens.where(F.col("word").isNotNull()).mapInArrow(run, schema)
    return jobs.start(out.writeStream.format("parquet").option("path", path).partitionBy("kind", "batch"), checkpoint, every)


def running_state_stream(
    numbered: str, line_schema: T.StructType, spark: SparkSession, out: str, checkpoint: str, seed: DataFrame | None = None, every: str | None = None
) -> StreamingQuery:
    """Second half: the counts by word and block go through the state, and give each token of their micro-batches its running count.

    ``numbered`` is what ``numbered_stream`` writes, ``line_schema`` the key columns of its lines. The result is a folder per run and batch below ``out``.
    """
    fields = [*line_schema.fields, T.StructField("pos", T.IntegerType()), T.StructField("word", T.StringType())]
    schema = T.StructType([*fields, T.StructField("block", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("batch", T.LongType())])
    counts = spark.readStream.schema(schema).parquet(numbered).where(F.col("kind") == COUNT).select("word", "batch", "block", "n")
    run = run_number(spark, out, checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        scratch = scratch_path(spark, "running-state")
        batch.select("word", "batch", "block", "before").write.parquet(scratch)
        starts = spark.read.parquet(scratch)
        low, high = starts.agg(F.min("batch"), F.max("batch")).first()
        tokens = spark.read.schema(schema).parquet(numbered).where((F.col("kind") == TOKEN) & F.col("batch").between(low, high) if low is not None else F.lit(False))
        counted = tokens.join(starts, ["word", "batch", "block"]).withColumn("n", F.col("before") + F.col("n"))
        counted.select(*[f.name for f in fields], "n").write.mode("overwrite").parquet(f"{out}/counts/run={run}/batch_id={batch_id}")
        Folders(spark, scratch).drop("")

    with rocks(spark):
        return jobs.start(word_totals(counts, seed).writeStream.outputMode("update").foreachBatch(put), checkpoint, every)


HELD = "held"
METRICS = ["orders", "succ", "fee", "cost_ms"]
_METRICS = T.StructType([f for f in S.CELL_SCHEMA.fields if f.name in METRICS])
_HELD = T.StructType([T.StructField("segment_ms", T.LongType()), T.StructField("write_ms", T.LongType()), *_METRICS.fields])
EXPIRING = T.StructType([T.StructField("day", T.StringType()), *_HELD.fields])


class ExpiringSums(StatefulProcessor):
    """Sums of a key that a write renews for ``ttl_ms``; a write after that starts afresh. A timer clears the state of what has expired."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState(HELD, _HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        start, last, orders, succ, fee, cost = self.held.get() if self.held.exists() else (None, None, 0, 0, Decimal(0), 0)
        if last is not None:
            self.handle.deleteTimer(last + self.ttl_ms)
        for r in sorted(rows, key=lambda r: r["write_ms"]):
            at = r["write_ms"]
            if last is None or at >= last + self.ttl_ms:
                start, orders, succ, fee, cost = at, 0, 0, Decimal(0), 0
            last = at if last is None else max(at, last)
            orders, succ, fee, cost = orders + r["orders"], succ + r["succ"], fee + r["fee"], cost + r["cost_ms"]
        self.held.update((start, last, orders, succ, fee, cost))
        self.handle.registerTimer(last + self.ttl_ms)
        yield Row(day=key[0], segment_ms=start, write_ms=last, orders=orders, succ=succ, fee=fee, cost_ms=cost)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def expiring_rows(spark: SparkSession, path: str) -> LatestRows:
    return LatestRows(spark, path, EXPIRING, ["day"]).create()


def expiring_stream(
    rows: DataFrame, ttl: int, latest: LatestRows, checkpoint: str, every: str | None = None, compact_every: int | None = 50
) -> StreamingQuery:
    """Daily sums of base rows with a ``write_time`` (without time zone, in UTC) that does not go back from batch to batch.

    A day without a write for ``ttl`` seconds starts from zero at its next one. The store has what each day holds or last held.
    """
    stamped = rows.withColumn("write_ms", times.utc_millis(F.col("write_time")))
    stamped = stamped.withColumn("_at", F.timestamp_millis("write_ms")).withWatermark("_at", "0 seconds")
    sums = stamped.select("day", "write_ms", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in _METRICS.fields])
    held = combined(sums, ["day", "write_ms"], METRICS).groupBy("day").transformWithState(ExpiringSums(1000 * ttl), EXPIRING, "update", "EventTime")
    latest.begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        latest.put(batch, batch_id)
        latest.after_batch(batch_id, compact_every)

    with rocks(rows.sparkSession):
        return jobs.start(held.writeStream.outputMode("update").foreachBatch(put), checkpoint, every)


def held_totals(latest: LatestRows, ttl: int) -> DataFrame:
    """``day, segment_start, expires_at`` and the sums of each day since it last began."""
    start, end = times.utc_timestamp(F.col("segment_ms")), times.utc_timestamp(F.col("write_ms") + 1000 * ttl)
    return latest.rows().select("day", start.alias("segment_start"), end.alias("expires_at"), "orders", "succ", F.col("fee").cast("double").alias("money"), "cost_ms")

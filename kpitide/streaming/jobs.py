"""The streaming jobs. Each takes a stream of lines and a sink, and returns the started query.

``every`` is the time between micro-batches; without it a job works off what is there and ends. A job
that is started again with its checkpoint goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from kpitide import schemas as S
from kpitide.operators import keyed, kpi, words
from kpitide.operators.parse import REASONS, checked_records, rejected_records
from kpitide.operators.project import base_projection, base_rows
from kpitide.session import scratch_path
from kpitide.sources import kafka
from kpitide.sources.folders import Folders
from kpitide.streaming.latest import LatestRows
from kpitide.streaming.partials import PartialSums
from kpitide.streaming.store import SEED_BATCH, WholeResults

# Name of the KPI query in its progress reports.
KPI_QUERY = "kpi"
# Name of the numbers of good and rejected lines in them.
CHECKED = "checked"

# Newest micro-batches of which a whole result is kept.
KEEP_BATCHES = 3

WINDOW_KEYS = ["window_start", "window_end"]
WINDOW_SUMS = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("orders", T.LongType()),
        T.StructField("succ", T.LongType()),
        T.StructField("fee", S.MONEY_SUM),
    ]
)
COUNTER_SUMS = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.LongType())])
LAST_KPIS = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("orders", T.LongType()),
        T.StructField("succ", T.LongType()),
        T.StructField("money", T.DoubleType()),
        T.StructField("cost_ms", T.LongType()),
    ]
)
WORD_SUMS = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def run(query: StreamingQuery) -> None:
    """Wait for a query that ends by itself."""
    query.awaitTermination()


def kpi_sums(spark: SparkSession, path: str, ttl: int | None = None) -> PartialSums:
    """The stored KPI cells of all grains. Each grain of a day expires as a whole."""
    keys = ["grain", *kpi.CELL_KEYS]
    return PartialSums(spark, path, S.CELL_SCHEMA, keys, ["grain", "day"], ttl).create()


def word_sums(spark: SparkSession, path: str, ttl: int | None = None) -> PartialSums:
    """Stored word counts. With ``ttl`` a word that stays away that long starts from zero again."""
    return PartialSums(spark, path, WORD_SUMS, ["word"], ["word"], ttl).create()


def kpi_stream(
    log: DataFrame,
    sums: PartialSums,
    checkpoint: str,
    every: str | None = None,
    column: str = "value",
    write_time: Callable[[int], Column] | None = None,
    compact_every: int | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """All KPI grains of each micro-batch, from one pass over it, into the stored cells.

    No state is kept in Spark: an order adds to its own day however late it comes. With ``rejects``, a path, the lines that cannot be counted
    are written from the same parse, one folder per run and batch, and their numbers by reason are in the query's progress (``reject_counts``).
    """
    sums.begin(checkpoint)

    def add(cells: DataFrame, batch_id: int) -> None:
        sums.put(cells, batch_id, write_time(batch_id) if write_time else None)

    def put(batch: DataFrame, batch_id: int) -> None:
        add(kpi.all_grains(batch), batch_id)
        sums.after_batch(batch_id, compact_every)

    def put_checked(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            add(kpi.all_grains(batch.where(F.col("reason").isNull())), batch_id)
            bad = batch.where(F.col("reason").isNotNull()).select("_line.*", "reason")
            bad.write.mode("overwrite").parquet(f"{rejects}/run={sums.run}/batch_id={batch_id}")
        finally:
            batch.unpersist()
        sums.after_batch(batch_id, compact_every)

    if not rejects:
        # The rows are planned with the stream, once, not anew for each micro-batch.
        return start(base_rows(log, column=column).writeStream.queryName(KPI_QUERY).foreachBatch(put), checkpoint, every)
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    checked = base_projection(checked_records(log, column), "reason", "_line").observe(CHECKED, *counts, F.count_if(F.col("reason").isNull()).alias("good"))
    return start(checked.writeStream.queryName(KPI_QUERY).foreachBatch(put_checked), checkpoint, every)


def reject_counts(query: StreamingQuery) -> dict[str, int]:
    """Lines of a KPI query by the reason why they were not counted, and ``good`` ones, over the micro-batches whose progress Spark still has."""
    found: dict[str, int] = dict.fromkeys([*REASONS, "good"], 0)
    for progress in query.recentProgress:
        seen = progress.observedMetrics.get(CHECKED)
        for name, n in seen.asDict().items() if seen is not None else ():
            found[name] += n
    return found


def daily_totals_stream(
    log: DataFrame,
    show: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    counters: PartialSums | None = None,
    prefix: str = "",
    compact_every: int | None = None,
) -> StreamingQuery:
    """Daily success count, amount and duration of each micro-batch by itself, handed to ``show``; counts also add to ``counters``."""
    if counters is not None:
        counters.begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        show(kpi.batch_totals(rows), batch_id)
        if counters is not None:
            counters.put(keyed.success_counter(rows, prefix), batch_id)
            counters.after_batch(batch_id, compact_every)

    return start(base_rows(log).writeStream.foreachBatch(put), checkpoint, every)


def reject_stream(log: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Lines that cannot be counted, appended with the reason."""
    return start(rejected_records(log).writeStream.format("parquet").option("path", path), checkpoint, every)


def window_sums(spark: SparkSession, path: str) -> PartialSums:
    return PartialSums(spark, path, WINDOW_SUMS, WINDOW_KEYS).create()


def window_stream(
    log: DataFrame,
    sums: PartialSums,
    checkpoint: str,
    width: str = "1 minute",
    every: str | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Sums by tumbling window of the order's own time, in UTC. An order adds to its window however late it comes."""
    sums.begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        sums.put(kpi.window_sums(batch, width), batch_id)
        sums.after_batch(batch_id, compact_every)

    return start(base_rows(log).writeStream.foreachBatch(put), checkpoint, every)


def counter_sums(spark: SparkSession, path: str) -> PartialSums:
    return PartialSums(spark, path, COUNTER_SUMS, ["key"]).create()


def counter_stream(
    log: DataFrame, sums: PartialSums, prefix: str, checkpoint: str, every: str | None = None, compact_every: int | None = None
) -> StreamingQuery:
    """The stored success counter of each day, under ``prefix`` and the day."""
    sums.begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        sums.put(keyed.success_counter(batch, prefix), batch_id)
        sums.after_batch(batch_id, compact_every)

    return start(base_rows(log).writeStream.foreachBatch(put), checkpoint, every)


def last_kpi_rows(spark: SparkSession, path: str, ttl: int | None = None) -> LatestRows:
    """The stored KPIs that each micro-batch overwrites."""
    return LatestRows(spark, path, LAST_KPIS, ["key"], ttl).create()


def overwrite_stream(
    log: DataFrame,
    latest: LatestRows,
    checkpoint: str,
    every: str | None = None,
    compact_every: int | None = 50,
    write_time: Callable[[int], Column] | None = None,
) -> StreamingQuery:
    """KPIs that each micro-batch overwrites: of each key the sums of the last batch that wrote it."""
    latest.begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        cells = kpi.all_grains(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), "batch_id")
        latest.put(keyed.last_batch_kpis(cells), batch_id, write_time(batch_id) if write_time else None)
        latest.after_batch(batch_id, compact_every)

    return start(base_rows(log).writeStream.foreachBatch(put), checkpoint, every)


def last_kpis(latest: LatestRows) -> DataFrame:
    """What overwriting has left under each key, with the ``batch_id`` of the write."""
    return latest.rows().withColumnRenamed("in_batch", "batch_id").drop("in_run")


def cumulative_word_stream(
    lines: DataFrame, path: str, checkpoint: str, delimiter: str = ",", every: str | None = None, keep: int = KEEP_BATCHES
) -> StreamingQuery:
    """Count of every word so far, all of them after each micro-batch, as ``WholeResults`` under ``path``."""
    counts = words.word_counts(words.tokenize(lines, delimiter=delimiter))
    results = WholeResults(lines.sparkSession, path, keep).begin(checkpoint)
    return start(counts.writeStream.outputMode("complete").foreachBatch(results.put), checkpoint, every)


def seeded_rows(spark: SparkSession, path: str) -> LatestRows:
    """The stored counts of the words that came, on top of a seed."""
    return LatestRows(spark, path, WORD_SUMS, ["word"]).create()


def seeded_word_stream(
    lines: DataFrame,
    seed: DataFrame,
    latest: LatestRows,
    checkpoint: str,
    delimiter: str = " ",
    every: str | None = None,
    compact_every: int | None = 50,
) -> StreamingQuery:
    """Count, on top of the seed, of the words that came in each micro-batch; a word's newest count replaces its older one.

    The seed is computed once, at the start. A run without the checkpoint before it counts from the seed again.
    """
    counts = words.word_counts(words.tokenize(lines, delimiter=delimiter))
    seed = stored_seed(seed)
    latest.begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        latest.put(words.seeded(batch, seed), batch_id)
        latest.after_batch(batch_id, compact_every)

    return start(counts.writeStream.outputMode("update").foreachBatch(put), checkpoint, every)


def seeded_counts(latest: LatestRows) -> DataFrame:
    """The newest count of each word that came in the newest run."""
    return latest.rows().where(F.col("in_run") == latest.newest_run()).select("word", "n")


def stored_seed(seed: DataFrame) -> DataFrame:
    """The seed as a table in the shared folder."""
    spark = seed.sparkSession
    path = scratch_path(spark, "seed")
    seed.write.parquet(path)
    return spark.read.schema(seed.schema).parquet(path)


def top_word_stream(
    lines: DataFrame, path: str, checkpoint: str, k: int = 10, delimiter: str = " ", every: str | None = None
) -> StreamingQuery:
    """The most frequent words so far, after each micro-batch, as ``WholeResults`` under ``path``."""
    counts = words.word_counts(words.tokenize(lines, delimiter=delimiter))
    results = WholeResults(lines.sparkSession, path, KEEP_BATCHES).begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        results.put(words.top_words(batch, k), batch_id)

    return start(counts.writeStream.outputMode("complete").foreachBatch(put), checkpoint, every)


def running_word_stream(
    lines: DataFrame,
    keys: list[str],
    totals: PartialSums,
    path: str,
    checkpoint: str,
    seed: DataFrame | None = None,
    delimiter: str = " ",
    every: str | None = None,
    compact_every: int | None = 100,
) -> StreamingQuery:
    """One output row per token: the word and its count so far, with the token itself.

    ``keys`` order the lines within a micro-batch; between batches the order is that of their arrival. The counts between batches are
    partial sums in ``totals``, so a word that makes up much of a batch needs no task of its own, as it would with grouped state.
    The seed goes into ``totals`` once, before the first batch of the first run.
    """
    spark = lines.sparkSession
    order = [*keys, "pos"]
    if seed is not None and not totals.has_batches():
        totals.put(seed.withColumnRenamed("n0", "n"), SEED_BATCH)
    totals.begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        base = totals.totals(before=batch_id).withColumnRenamed("n", "n0")
        tokens = words.tokenize(batch, *keys, delimiter=delimiter)
        out = f"{path}/run={totals.run}/batch_id={batch_id}"
        scratch = scratch_path(spark, "running-count")
        words.running_count(tokens, "word", order, base=base, scratch=scratch).write.mode("overwrite").parquet(out)
        Folders(spark, scratch).drop("")
        totals.put(words.word_counts(spark.read.parquet(out)), batch_id)
        totals.after_batch(batch_id, compact_every)

    return start(lines.writeStream.foreachBatch(put), checkpoint, every)


def console_stream(
    df: DataFrame, checkpoint: str, rows: int = 10, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    """Print the first rows of each micro-batch."""
    writer = df.writeStream.outputMode(mode).format("console").option("numRows", rows).option("truncate", False)
    return start(writer, checkpoint, every)


def kafka_stream(
    lines: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    every: str | None = None,
    key: str | None = None,
    partition: str | None = None,
) -> StreamingQuery:
    """Write lines to a topic; trigger and files per batch set the pace. ``key`` and ``partition`` name columns of the lines."""
    writer = kafka.to_messages(lines, key=key, partition=None if partition is None else F.col(partition)).writeStream.format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return start(writer, checkpoint, every)


def put_partitions(df: DataFrame, connect: Callable, put: Callable) -> None:
    """Write rows to an outside store with one connection per partition: ``connect()``, then ``put(connection, row)``."""

    def write(rows) -> None:
        connection = connect()
        try:
            for row in rows:
                put(connection, row)
        finally:
            connection.close()

    df.foreachPartition(write)


class LedgerListener(StreamingQueryListener):
    """Stores the end offsets of a Kafka query's batches, each after its batch is done.

    The ledger never runs ahead of the results. Recovery itself goes by the checkpoint; the ledger is for
    jobs that start without one, through ``resume_offsets``. Only the newest ``KEEP_BATCHES`` entries of a run stay.
    """

    def __init__(self, spark: SparkSession, path: str, group: str, query_name: str, run: int = 0):
        self.spark = spark
        self.path = path
        self.group = group
        self.query_name = query_name
        self.run = run

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name == self.query_name:
            self.store([s.endOffset for s in progress.sources], progress.batchId)

    def store(self, end_offsets: list[str], batch_id: int) -> None:
        for n, end in enumerate(end_offsets):
            rows = kafka.ledger_from_progress(self.spark, end, self.group)
            rows.write.mode("overwrite").parquet(f"{self.path}/run={self.run}/batch_id={batch_id}/source={n}")
        folders = Folders(self.spark, f"{self.path}/run={self.run}")
        for name in folders.names():
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= batch_id - KEEP_BATCHES:
                folders.drop(name)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stored_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Newest stored offset of each partition: of the newest run, and in it of the newest batch."""
    written = spark.read.parquet(path).withColumn("_version", F.struct("run", "batch_id"))
    return written.groupBy("topic", "groupid", "partitions").agg(F.max_by("offset", "_version").alias("offset"))


def watch(queries: list[StreamingQuery]) -> None:
    """Wait until all queries have ended. If one fails, stop the others and raise its error."""
    waiting = list(queries)
    try:
        while waiting:
            for query in list(waiting):
                if query.awaitTermination(1):
                    waiting.remove(query)
    finally:
        for query in waiting:
            query.stop()

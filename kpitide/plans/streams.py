"""Streaming jobs run over a whole table to its end, with their sinks read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpitide.plans import words as word_plans
from kpitide.plans.fixture_sql import tokens
from kpitide.plans import recharge
from kpitide.plans.recharge import COUNTER_PREFIX, grouping_sets_sql, window_sql
from kpitide.plans.registry import Query
from kpitide.session import scratch_path
from kpitide.sources import tables
from kpitide.operators.project import base_rows
from kpitide.schemas import rows_of
from kpitide.streaming import event_time, jobs, keyed_state, top
from kpitide.streaming.store import WholeResults

LAST_VALUE_BATCHES = 8


def _log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.recharge_log(tables.stream_table(spark, sf_dir, "events"))


def _line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.word_lines(tables.stream_table(spark, sf_dir, "conversations"))


def stream_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-kpi")
    sums = jobs.kpi_sums(spark, f"{path}/cells")
    jobs.run(jobs.kpi_stream(_log_stream(spark, sf_dir), sums, f"{path}/checkpoint"))
    return sums.totals().withColumn("fee", F.col("fee").cast("double"))


def word_count_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "word-count")
    jobs.run(jobs.cumulative_word_stream(_line_stream(spark, sf_dir), f"{path}/out", f"{path}/checkpoint"))
    return WholeResults(spark, f"{path}/out", jobs.KEEP_BATCHES).newest()


def stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-running-count")
    totals = jobs.word_sums(spark, f"{path}/totals")
    seed = word_plans.seed(spark, sf_dir)
    table, parts = tables.stream_parts(spark, sf_dir, "conversations", "conv_id")
    for _ in parts:  # a batch each: the job goes on from its checkpoint
        jobs.run(
            jobs.running_word_stream(
                tables.word_lines(table), word_plans.LINE_KEYS, totals, f"{path}/out", f"{path}/checkpoint", seed=seed, compact_every=2
            )
        )
    return spark.read.parquet(f"{path}/out").drop("run", "batch_id")


def stream_minute_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-window")
    sums = jobs.window_sums(spark, f"{path}/windows")
    jobs.run(jobs.window_stream(_log_stream(spark, sf_dir), sums, f"{path}/checkpoint"))
    return sums.totals().select("window_start", "window_end", "orders", "succ", F.col("fee").cast("double").alias("money"))


def stream_success_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-counter")
    sums = jobs.counter_sums(spark, f"{path}/counters")
    jobs.run(jobs.counter_stream(_log_stream(spark, sf_dir), sums, COUNTER_PREFIX, f"{path}/checkpoint"))
    return sums.totals()


def stream_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-last-value")
    latest = jobs.last_kpi_rows(spark, f"{path}/kpis")
    table, parts = tables.stream_parts(spark, sf_dir, "events", "event_id", LAST_VALUE_BATCHES)
    for _ in parts:  # folded every other batch
        jobs.run(jobs.overwrite_stream(tables.recharge_log(table), latest, f"{path}/checkpoint", compact_every=2))
    return jobs.last_kpis(latest)


def stream_seeded_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-seeded")
    seed = word_plans.seed(spark, sf_dir)
    latest = jobs.seeded_rows(spark, f"{path}/out")
    jobs.run(jobs.seeded_word_stream(_line_stream(spark, sf_dir), seed, latest, f"{path}/checkpoint", compact_every=2))
    return jobs.seeded_counts(latest)


def stream_top10_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-top-words")
    jobs.run(jobs.top_word_stream(_line_stream(spark, sf_dir), f"{path}/out", f"{path}/checkpoint"))
    return WholeResults(spark, f"{path}/out", jobs.KEEP_BATCHES).newest()


def stream_closing_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows closed by the watermark, late orders and open windows together."""
    path = scratch_path(spark, "stream-closing")
    store = event_time.window_store(spark, f"{path}/windows")
    jobs.run(event_time.closing_window_stream(_log_stream(spark, sf_dir), store, f"{path}/checkpoint", compact_every=2))
    whole = event_time.all_windows(store, f"{path}/checkpoint")
    return whole.select("window_start", "window_end", "orders", "succ", F.col("fee").cast("double").alias("money"))


def stream_state_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-state-running")
    seed = word_plans.seed(spark, sf_dir)
    table, parts = tables.stream_parts(spark, sf_dir, "conversations", "conv_id")
    lines = tables.word_lines(table)
    keys = T.StructType([lines.schema[k] for k in word_plans.LINE_KEYS])
    for _ in parts:
        jobs.run(keyed_state.numbered_stream(lines, word_plans.LINE_KEYS, f"{path}/numbered", f"{path}/first"))
        jobs.run(keyed_state.running_state_stream(f"{path}/numbered", keys, spark, f"{path}/out", f"{path}/second", seed))
    return spark.read.parquet(f"{path}/out/counts").drop("run", "batch_id")


def stream_state_seeded_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-state-seeded")
    seed = word_plans.seed(spark, sf_dir)
    latest = jobs.seeded_rows(spark, f"{path}/out")
    jobs.run(keyed_state.seeded_state_stream(_line_stream(spark, sf_dir), seed, latest, f"{path}/checkpoint", compact_every=2))
    return jobs.seeded_counts(latest)


def stream_state_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums that expire in the state; the write times go on from part to part."""
    path = scratch_path(spark, "stream-state-ttl")
    latest = keyed_state.expiring_rows(spark, f"{path}/out")
    table, parts = tables.stream_ranges(spark, sf_dir, "events", tables.batch_id())
    rows = base_rows(tables.recharge_log(table), "batch_id").withColumn("write_time", tables.write_time())
    for _ in parts:
        jobs.run(keyed_state.expiring_stream(rows, recharge.RESTART_TTL, latest, f"{path}/checkpoint", compact_every=2))
    return keyed_state.held_totals(latest, recharge.RESTART_TTL)


def stream_top10_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-top-sketch")
    store = top.top_store(spark, path)
    jobs.run(top.top_sketch_stream(_line_stream(spark, sf_dir), store, f"{path}/checkpoint", compact_every=2))
    return top.top_words(store)


def stream_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines by reason, as the progress of the KPI query counts them beside the KPIs; one row per reason comes from the driver."""
    path = scratch_path(spark, "stream-rejects")
    sums = jobs.kpi_sums(spark, f"{path}/cells")
    log = tables.damaged_log(tables.stream_table(spark, sf_dir, "events"))
    query = jobs.kpi_stream(log, sums, f"{path}/checkpoint", rejects=f"{path}/rejects")
    jobs.run(query)
    counts = [(reason, n) for reason, n in jobs.reject_counts(query).items() if n]
    return rows_of(spark, counts, "reason", "n").withColumn("n", F.col("n").cast("bigint"))


RUNNING_SQL = f"""WITH {tokens()}, {word_plans.SEED_SQL}
            SELECT conv_id, turn, line, pos, t.word,
                   coalesce(n0, 0) + count(*) OVER (PARTITION BY t.word ORDER BY conv_id % 4, conv_id, turn, line, pos
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
            FROM tokens t LEFT JOIN seed ON seed.word = t.word"""

QUERIES = {
    "stream_top10_sketch": Query(stream_top10_sketch, word_plans.QUERIES["top10_words"].sql),
    "stream_reject_counts": Query(
        stream_reject_counts,
        f"""WITH rejected AS ({recharge.QUERIES["rejected_records"].sql}),
            kept AS ({recharge.QUERIES["rejects_left_out"].sql})
            SELECT reason, count(*) AS n FROM rejected GROUP BY reason
            UNION ALL SELECT 'good' AS reason, CAST(sum(orders) AS BIGINT) AS n FROM kept""",
    ),
    "stream_closing_windows": Query(stream_closing_windows, window_sql("minute")),
    "stream_state_running_count": Query(stream_state_running_count, RUNNING_SQL),
    "stream_state_seeded_count": Query(stream_state_seeded_count, word_plans.QUERIES["seeded_word_count"].sql),
    "stream_state_ttl": Query(stream_state_ttl, recharge.QUERIES["kpi_ttl_restart"].sql),
    "stream_minute_window": Query(stream_minute_window, window_sql("minute")),
    "stream_success_counter": Query(stream_success_counter, recharge.QUERIES["daily_success_counter"].sql),
    "stream_last_value": Query(stream_last_value, recharge.last_value_sql(f"seq % {LAST_VALUE_BATCHES}")),
    "stream_seeded_word_count": Query(stream_seeded_word_count, word_plans.QUERIES["seeded_word_count"].sql),
    "stream_top10_words": Query(stream_top10_words, word_plans.QUERIES["top10_words"].sql),
    "stream_kpi": Query(stream_kpi, grouping_sets_sql()),
    "word_count_cumulative": Query(
        word_count_cumulative, f"WITH {tokens(',')} SELECT word, count(*) AS n FROM tokens GROUP BY word"
    ),
    "stream_running_count": Query(stream_running_count, RUNNING_SQL),
}

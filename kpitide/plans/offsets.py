"""Queries over Kafka-like records and their offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpitide.operators import offsets as O
from kpitide.plans.fixture_sql import RECORDS
from kpitide.plans.registry import Query
from kpitide.sources import tables

CONSUMER = "consumer: 0"
GROUP = "g0"
# The ledger fixture: group g0 has not seen partition 3, and stopped early in the topic 'error'; group g1 has seen all.
NEW_PARTITION = 3
STALE_TOPIC = "error"
STALE_UNTIL = "2024-01-08"
# Records before this day are no longer held.
HELD_SINCE = "2024-01-16"
ASSIGN_PARTITIONS = 7


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.kafka_records(tables.table(spark, sf_dir, "events"))


def record_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.record_metadata(records(spark, sf_dir), CONSUMER)


def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.offset_ranges(records(spark, sf_dir))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger after both groups have committed their batches."""
    read = records(spark, sf_dir)
    stale = (F.col("topic") == STALE_TOPIC) & (F.col("ts") >= F.to_timestamp_ntz(F.lit(STALE_UNTIL)))
    by_g0 = (F.col("partition") != NEW_PARTITION) & ~stale
    groups = F.when(by_g0, F.array(F.lit("g0"), F.lit("g1"))).otherwise(F.array(F.lit("g1")))
    # The group is an expression of the record, so both groups come from one pass and one shuffle.
    committed = read.select("topic", "partition", "offset", "batch_id", F.explode(groups).alias("groupid"))
    ranges = committed.groupBy("topic", "groupid", "partition", "batch_id").agg(
        (F.max("offset") + 1).alias("until_offset")
    )
    return O.upsert_ledger(ranges)


def offset_ledger_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.ledger_by_group(ledger(spark, sf_dir), GROUP)


def earliest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = records(spark, sf_dir).where(F.col("ts") >= F.to_timestamp_ntz(F.lit(HELD_SINCE)))
    return O.earliest_offsets(held)


def resume_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.resume_offsets(offset_ledger_by_group(spark, sf_dir), earliest_offsets(spark, sf_dir))


def partition_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.table(spark, sf_dir, "events").select("event_id", "event_type", "props", "user_id")
    keyed = events.select("event_id", F.concat("event_type", F.lit(":"), "props").alias("text_key"), "user_id")
    by_text = O.assign_partitions(keyed, "text_key", ASSIGN_PARTITIONS, "text_partition")
    return O.assign_partitions(by_text, "user_id", ASSIGN_PARTITIONS, "number_partition")


_LEDGER = f"""{RECORDS},
committed AS (
  SELECT *, 'g1' AS groupid FROM records
  UNION ALL
  SELECT *, 'g0' AS groupid FROM records
  WHERE partition <> {NEW_PARTITION} AND NOT (topic = '{STALE_TOPIC}' AND ts >= TIMESTAMP '{STALE_UNTIL} 00:00:00')
),
ledger AS (
  SELECT topic, groupid, partition AS partitions, until_offset AS "offset"
  FROM (SELECT topic, groupid, partition, batch_id, max("offset") + 1 AS until_offset FROM committed GROUP BY ALL) AS ranges
  QUALIFY row_number() OVER (PARTITION BY topic, groupid, partition ORDER BY batch_id DESC) = 1
)"""
_EARLIEST = f"""
earliest AS (
  SELECT topic, partition, min("offset") AS "offset" FROM records
  WHERE ts >= TIMESTAMP '{HELD_SINCE} 00:00:00' GROUP BY topic, partition
)"""

QUERIES = {
    "record_metadata": Query(
        record_metadata,
        f"""WITH {RECORDS} SELECT topic, partition, "offset", msg,
            'Consumer: {CONSUMER}, Topic: ' || topic || ', Offset: ' || "offset" || ', msg: ' || msg AS line
            FROM records""",
    ),
    "offset_ranges": Query(
        offset_ranges,
        f"""WITH {RECORDS} SELECT topic, partition, batch_id, min("offset") AS from_offset,
            max("offset") + 1 AS until_offset FROM records GROUP BY topic, partition, batch_id""",
    ),
    "offset_ledger_upsert": Query(ledger, f"WITH {_LEDGER} SELECT * FROM ledger"),
    "offset_ledger_by_group": Query(
        offset_ledger_by_group, f"WITH {_LEDGER} SELECT * FROM ledger WHERE groupid = '{GROUP}'"
    ),
    "earliest_offsets": Query(earliest_offsets, f"WITH {RECORDS}, {_EARLIEST} SELECT * FROM earliest"),
    "resume_offsets": Query(
        resume_offsets,
        f"""WITH {_LEDGER}, {_EARLIEST}
            SELECT e.topic, e.partition, greatest(e."offset", coalesce(l."offset", e."offset")) AS "offset"
            FROM earliest e LEFT JOIN ledger l
              ON l.topic = e.topic AND l.partitions = e.partition AND l.groupid = '{GROUP}'""",
    ),
    "partition_assign": Query(
        partition_assign,
        f"""WITH keyed AS (
              SELECT event_id, event_type || ':' || props AS text_key, user_id FROM events
            ),
            hashed AS (
              SELECT *, list_reduce(
                  list_prepend(CAST(0 AS BIGINT),
                               list_transform(string_split(text_key, ''), lambda c: CAST(unicode(c) AS BIGINT))),
                  lambda h, c: (h * 31 + c) % 4294967296) AS h
              FROM keyed
            )
            SELECT event_id, text_key, user_id,
                   CAST((CASE WHEN h = 2147483648 THEN 0 WHEN h > 2147483648 THEN 4294967296 - h ELSE h END)
                        % {ASSIGN_PARTITIONS} AS INTEGER) AS text_partition,
                   CAST(user_id % {ASSIGN_PARTITIONS} AS INTEGER) AS number_partition
            FROM hashed""",
    ),
}

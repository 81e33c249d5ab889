"""Offset bookkeeping over Kafka-like records: topic, partition, offset, value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpitide.functions.hashing import long_hash_code, partition_of, string_hash_code
from kpitide.functions.text import record_line


def record_metadata(records: DataFrame, consumer: str) -> DataFrame:
    """Records with their bytes as text, and a display line."""
    msg = F.decode("value", "UTF-8")
    return records.select(
        "topic",
        "partition",
        "offset",
        msg.alias("msg"),
        record_line(consumer, F.col("topic"), F.col("offset"), msg).alias("line"),
    )


def offset_ranges(records: DataFrame) -> DataFrame:
    """First and end offset of each batch in each partition."""
    return records.groupBy("topic", "partition", "batch_id").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def upsert_ledger(ranges: DataFrame) -> DataFrame:
    """Ledger rows after replacing each key's row by the one of its newest batch."""
    return ranges.groupBy("topic", "groupid", F.col("partition").alias("partitions")).agg(
        F.max_by("until_offset", "batch_id").alias("offset")
    )


def ledger_by_group(ledger: DataFrame, group: str) -> DataFrame:
    return ledger.where(F.col("groupid") == group)


def earliest_offsets(records: DataFrame) -> DataFrame:
    """Earliest offset still held of each partition."""
    return records.groupBy("topic", "partition").agg(F.min("offset").alias("offset"))


def resume_offsets(ledger: DataFrame, earliest: DataFrame) -> DataFrame:
    """Where each partition is read from: the stored offset, or the earliest one if that is larger.

    Partitions without a stored offset start at the earliest one. Both inputs hold one row per partition.
    """
    stored = ledger.select("topic", F.col("partitions").alias("partition"), F.col("offset").alias("_stored"))
    return earliest.join(stored, ["topic", "partition"], "left").select(
        "topic", "partition", F.greatest("offset", "_stored").alias("offset")
    )


def assign_partitions(df: DataFrame, key: str, partitions: int, name: str = "partition") -> DataFrame:
    """Add the partition a JVM hash partitioner gives the key; text and whole-number keys."""
    is_text = dict(df.dtypes)[key] == "string"
    code = string_hash_code(F.col(key)) if is_text else long_hash_code(F.col(key))
    return df.withColumn(name, partition_of(code, partitions))

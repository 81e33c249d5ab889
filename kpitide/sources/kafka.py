"""Kafka source and sink.

Both need the ``spark-sql-kafka`` package on the cluster. The options are plain dictionaries, so that a job can be
checked without a broker.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What the source reads as "from the earliest record".
EARLIEST = -2


def topic_list(topics: str | Iterable[str]) -> str:
    """Topics as the source wants them: no blanks, no empty names, each once, in a fixed order."""
    names = topics.split(",") if isinstance(topics, str) else topics
    cleaned = sorted({n.strip() for n in names} - {""})
    if not cleaned:
        raise ValueError("no topic given")
    return ",".join(cleaned)


def rate_cap(per_partition_per_second: int, partitions: int, batch_seconds: float) -> int:
    """Records per batch that a cap per partition and second allows."""
    return max(1, int(per_partition_per_second * partitions * batch_seconds))


def read_options(
    servers: str,
    topics: str | Iterable[str],
    *,
    starting_offsets: str = "earliest",
    group: str | None = None,
    max_per_batch: int | None = None,
    min_partitions: int | None = None,
    skip_lost: bool = False,
) -> dict[str, str]:
    """Options of a read. A streaming query with a checkpoint uses ``starting_offsets`` only on its first start.

    With ``skip_lost`` a partition whose next records are no longer held goes on at its earliest ones.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic_list(topics),
        "startingOffsets": starting_offsets,
    }
    if skip_lost:
        options["failOnDataLoss"] = "false"
    if group is not None:
        options["kafka.group.id"] = group
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def starting_offsets_json(resume: DataFrame, partition_counts: dict[str, int] | None = None) -> str:
    """The ``startingOffsets`` text of resume points ``topic, partition, offset``.

    The source wants every partition named. ``partition_counts`` gives the number of partitions per
    topic; those without a resume point start at their earliest record. The driver needs this text
    whole; it has one number per partition of the topics read.
    """
    by_topic = {
        topic: {str(n): EARLIEST for n in range(count)} for topic, count in (partition_counts or {}).items()
    }
    for row in resume.select("topic", "partition", "offset").toLocalIterator():
        by_topic.setdefault(row["topic"], {})[str(row["partition"])] = row["offset"]
    return json.dumps(by_topic, sort_keys=True)


def ledger_from_progress(spark: SparkSession, end_offset: str | dict, group: str) -> DataFrame:
    """Ledger rows from the ``endOffset`` a query reports for a Kafka source after a batch."""
    by_topic = json.loads(end_offset) if isinstance(end_offset, str) else end_offset
    rows = [
        (topic, group, int(partition), int(offset))
        for topic, partitions in sorted(by_topic.items())
        for partition, offset in sorted(partitions.items())
    ]
    return spark.createDataFrame(rows, "topic string, groupid string, partitions int, offset bigint")


def records(raw: DataFrame) -> DataFrame:
    """Key and value as text, beside where the record came from."""
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def read_raw_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Records with their bytes as they are."""
    return spark.readStream.format("kafka").options(**options).load()


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return records(read_raw_stream(spark, options))


def read_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return records(spark.read.format("kafka").options(**options).load())


def to_messages(lines: DataFrame, value: str = "value", key: str | None = None, partition: Column | None = None) -> DataFrame:
    """Lines in the shape the Kafka sink takes."""
    columns = [F.col(value).cast("string").alias("value")]
    if key is not None:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    if partition is not None:
        columns.append(partition.cast("int").alias("partition"))
    return lines.select(*columns)


def write_batch(messages: DataFrame, servers: str, topic: str, acks: str = "1") -> None:
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("kafka.acks", acks).option("topic", topic).save()

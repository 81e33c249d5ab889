"""Text lines from files and sockets, as a batch or a stream of one ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket. It cannot be replayed, so it is for trials; jobs read files or Kafka."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()

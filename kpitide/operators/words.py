"""Word counts over text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpitide.functions.text import split_tokens
from kpitide.session import scratch_path


def text_lines(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """One row per line of a text: the keys, ``line`` (from 0) and ``value``."""
    return df.select(*keys, F.posexplode(F.split(text, "\n")).alias("line", "value"))


def tokenize(lines: DataFrame, *keys: str, delimiter: str = " ") -> DataFrame:
    """One row per token: the keys, ``pos`` (from 0) and ``word``."""
    return lines.select(*keys, F.posexplode(split_tokens(F.col("value"), delimiter)).alias("pos", "word"))


def word_counts(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def seeded(counts: DataFrame, seed: DataFrame) -> DataFrame:
    """Counts on top of a seed table ``word, n0``. Words only the seed has are left out, as nothing arrived for them."""
    return counts.join(seed, "word", "left").select("word", (F.col("n") + F.coalesce("n0", F.lit(0))).alias("n"))


def top_words(counts: DataFrame, k: int = 10) -> DataFrame:
    return counts.orderBy(F.desc("n"), "word").limit(k)


def running_count(
    df: DataFrame, key: str, order: Sequence[str], name: str = "n", base: DataFrame | None = None, scratch: str | None = None
) -> DataFrame:
    """Add the number of rows of the same ``key`` up to and with this one, in the order of unique columns.

    ``base`` holds counts to start from: the key column and ``n0``, one row per key.

    A window over the key would sort all rows of a frequent word in one task. Here the rows are
    range-partitioned by the order into even blocks, rows are numbered within key and block, and the
    key's count in the blocks before is added. A task holds a key's rows of one block, or one count per block.

    Block numbers depend on sampled bounds, so the blocks are written to the shared folder (or to ``scratch``) before they are used twice.

    Rows whose key is null are left out. The join is on plain equality then, which keeps the partitioning of the window, so a token is
    shuffled once.
    """
    spark = df.sparkSession
    path = scratch or scratch_path(spark, "running-count")
    ranged = df.where(F.col(key).isNotNull()).repartitionByRange(*order).withColumn("_block", F.spark_partition_id())
    ranged.write.parquet(path)
    blocks = spark.read.schema(ranged.schema).parquet(path)

    per_block = blocks.groupBy(F.col(key).alias("_key"), F.col("_block").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = per_block.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    if base is not None:
        start = base.select(F.col(key).alias("_base_key"), F.col("n0").alias("_n0"))
        before = before.join(start, F.col("_key") == F.col("_base_key"), "left").select(
            "_key", "_b", (F.col("_before") + F.coalesce("_n0", F.lit(0))).alias("_before")
        )
    within = F.row_number().over(Window.partitionBy(key, "_block").orderBy(*order)).cast("bigint")
    numbered = blocks.withColumn("_within", within)
    same = (F.col(key) == F.col("_key")) & (F.col("_block") == F.col("_b"))
    return numbered.join(before, same).select(*df.columns, (F.col("_before") + F.col("_within")).alias(name))

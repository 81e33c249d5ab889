"""What the jobs with state of their own share: the state store, and rows combined before they meet the state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB for the queries started inside; a query keeps the setting it was started with."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def combined(rows: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sums by key within each task and batch of rows, so that a frequent key is few rows before the shuffle.

    A streaming aggregation would do so too, but keep every key as state.
    """
    picked = rows.select(*keys, *sums)
    names, schema = picked.columns, picked.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                table = pa.Table.from_batches([b]).group_by(list(keys)).aggregate([(s, "sum") for s in sums])
                table = table.select([*keys, *[f"{s}_sum" for s in sums]]).rename_columns(names)
                yield from table.cast(b.schema).to_batches()

    return picked.mapInArrow(run, schema)


def state_of(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """What the state of that name holds for each key, after the last batch that is done."""
    stored = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()
    return stored.select("key.*", "value.*")

"""The offset ledger in a database or as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpitide.operators.offsets import ledger_by_group
from kpitide.schemas import LEDGER_SCHEMA


def jdbc_options(url: str, table: str, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "pushDownPredicate": "true", **extra}


def read_jdbc(spark: SparkSession, options: dict[str, str], group: str) -> DataFrame:
    """The group's rows; Spark hands the filter to the database."""
    table = spark.read.format("jdbc").options(**options).load()
    typed = table.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields])
    return ledger_by_group(typed, group)


def read_files(spark: SparkSession, path: str, group: str) -> DataFrame:
    return ledger_by_group(spark.read.schema(LEDGER_SCHEMA).parquet(path), group)

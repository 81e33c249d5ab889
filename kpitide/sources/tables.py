"""The inputs of the registered queries, derived by Spark from the given tables.

A recharge log is laid over ``events``, Kafka-like records over ``events`` too, and word lines over ``conversations``.
Every column is an expression of its own row, so deriving an input takes no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpitide import schemas as S
from kpitide.operators.words import text_lines
from kpitide.session import scratch_path

BATCH_MINUTES = 10
UNKNOWN_CODES = ["999", "000"]
RECORD_PARTITIONS = 4
STREAM_BATCHES = 4



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, batches: int = STREAM_BATCHES) -> DataFrame:
    """The table as a stream of ``batches`` micro-batches: dealt to files in the shared folder, of which as many make a batch as tasks can run at a time."""
    df = table(spark, sf_dir, name)
    per_batch = spark.sparkContext.defaultParallelism
    path = scratch_path(spark, f"stream-{name}")
    df.repartition(batches * per_batch).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def stream_parts(spark: SparkSession, sf_dir: str, name: str, key: str, parts: int = STREAM_BATCHES) -> tuple[DataFrame, Iterator[int]]:
    """The table as a stream of a growing folder, and its parts: each step adds the rows whose key leaves that remainder."""
    df = table(spark, sf_dir, name)
    path = scratch_path(spark, f"parts-{name}")
    spark.createDataFrame([], df.schema).write.parquet(path)

    def add() -> Iterator[int]:
        for part in range(parts):
            df.where(F.pmod(F.col(key), F.lit(parts)) == part).write.mode("append").parquet(path)
            yield part

    return spark.readStream.schema(df.schema).parquet(path), add()


def stream_ranges(spark: SparkSession, sf_dir: str, name: str, order: Column, parts: int = STREAM_BATCHES) -> tuple[DataFrame, Iterator[int]]:
    """The table as a stream of a growing folder, in the order of a whole number: each step adds the rows of the next of equal ranges."""
    df = table(spark, sf_dir, name)
    path = scratch_path(spark, f"ranges-{name}")
    spark.createDataFrame([], df.schema).write.parquet(path)
    low, high = df.agg(F.min(order), F.max(order)).first()

    def add() -> Iterator[int]:
        for part in range(parts if low is not None else 0):
            at = F.floor((order - low) * parts / (high - low + 1))
            df.where(at == part).write.mode("append").parquet(path)
            yield part

    return spark.readStream.schema(df.schema).parquet(path), add()


def batch_id() -> Column:
    """Number of the ten-minute interval of ``ts``, counted from the epoch."""
    per_day = 24 * 60 // BATCH_MINUTES
    per_hour = 60 // BATCH_MINUTES
    ts = F.col("ts")
    slot = F.unix_date(ts.cast("date")) * per_day + F.hour(ts) * per_hour + F.floor(F.minute(ts) / BATCH_MINUTES)
    return slot.cast("bigint")


def write_time() -> Column:
    """End of the batch's interval."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_add("MINUTE", ((F.col("batch_id") + 1) * BATCH_MINUTES).cast("int"), epoch)


def _compact(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmssSSS")


def _fields() -> dict[str, Column]:
    """Fields of the recharge record an event stands for."""
    kind, value, ts = F.col("event_type"), F.col("value"), F.col("ts")
    codes = [code for code, _ in S.PROVINCES] + UNKNOWN_CODES
    position = F.pmod("user_id", F.lit(len(codes))) + 1
    return {
        S.SERVICE_NAME: F.when(kind == "view", "sendRechargeReq")
        .when(kind == "click", S.RECHARGE_SERVICE.upper())
        .otherwise(S.RECHARGE_SERVICE),
        S.RESULT: F.when(kind == "error", "0001").otherwise(S.SUCCESS),
        S.FEE: value.cast(S.MONEY).cast("string"),
        S.PROVINCE_CODE: F.element_at(F.array(*[F.lit(c) for c in codes]), position.cast("int")),
        S.REQUEST_ID: F.concat(_compact(ts), F.lpad(F.col("event_id").cast("string"), 15, "0")),
        S.RECEIVE_TIME: _compact(F.timestamp_add("MILLISECOND", (value * 100).cast("int"), ts)),
    }


def _json(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))


def recharge_log(events: DataFrame) -> DataFrame:
    """``seq, batch_id, value``: one JSON line per event.

    The line goes through ``inline``, or a filter on it would make the JSON a second time below the projection.
    """
    line = F.struct(_json(_fields()).alias("value"))
    return events.select(F.col("event_id").alias("seq"), batch_id().alias("batch_id"), F.inline(F.array(line)))


# Each kind of damage hits the events whose id leaves its number as the remainder by DAMAGE_CYCLE.
DAMAGE_CYCLE = 16


def damaged_log(events: DataFrame) -> DataFrame:
    """The recharge log with some lines spoilt, one way after the other, and some only with white space around them."""
    fields = _fields()
    kind = F.pmod("event_id", F.lit(DAMAGE_CYCLE))

    def without(name: str) -> Column:
        return _json({k: v for k, v in fields.items() if k != name})

    def having(**changes: Column) -> Column:
        return _json({**fields, **changes})

    whole = _json(fields)
    month_13 = F.concat(F.lit("20241301"), F.substring(fields[S.REQUEST_ID], 9, 24))
    value = (
        F.when(kind == 0, F.substring(whole, 1, 40))
        .when(kind == 1, without(S.SERVICE_NAME))
        .when(kind == 2, without(S.RESULT))
        .when(kind == 3, having(**{S.REQUEST_ID: F.substring(fields[S.REQUEST_ID], 1, 16)}))
        .when(kind == 4, having(**{S.REQUEST_ID: month_13}))
        .when(kind == 5, having(**{S.FEE: F.lit("abc")}))
        .when(kind == 6, F.lit(""))
        .when(kind == 7, having(**{S.RECEIVE_TIME: F.lit("soon")}))
        .when(kind == 8, F.concat(whole, F.lit(" "), whole))
        .when(kind == 9, F.concat(F.lit("\n\t"), whole, F.lit("\t\r\n")))
        .otherwise(whole)
    )
    return events.select(F.col("event_id").alias("seq"), F.inline(F.array(F.struct(value.alias("value")))))


def kafka_records(events: DataFrame) -> DataFrame:
    """Kafka-like records. The event id is the offset: it grows within each partition, with gaps, as in a compacted topic."""
    return events.select(
        F.col("event_type").alias("topic"),
        F.pmod("user_id", F.lit(RECORD_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.encode("props", "UTF-8").alias("value"),
        batch_id().alias("batch_id"),
        "ts",
    )


def word_lines(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, line, value``: the lines of each turn."""
    return text_lines(conversations, "text", "conv_id", "turn")

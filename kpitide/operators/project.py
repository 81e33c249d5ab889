"""Recharge records to the base rows all KPIs are counted from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpitide import schemas as S
from kpitide.functions import times
from kpitide.operators.parse import recharge_records


def _cost_ms() -> Column:
    end = times.millis_of(F.col("end_ts"), F.col("end_no"))
    return end - times.millis_of(F.col("start_ts"), F.col("start_no"))


def base_projection(records: DataFrame, *carry: str) -> DataFrame:
    """Time keys, province and the metrics of each checked record, beside the ``carry`` columns.

    Fee and duration count only for successful orders.
    """
    request_id = F.col("request_id")
    ok = F.col("result") == S.SUCCESS
    zero_money = F.lit(0).cast(S.MONEY)
    return records.select(
        *carry,
        "request_id",
        "province_code",
        "result",
        times.day_key(request_id).alias("day"),
        times.hour_key(request_id).alias("hour"),
        times.minute_key(request_id).alias("minute"),
        "start_ts",
        "end_ts",
        F.lit(1).cast("bigint").alias("orders"),
        ok.cast("bigint").alias("succ"),
        (~ok).cast("bigint").alias("fail"),
        F.when(ok, F.col("amount")).otherwise(zero_money).alias("fee"),
        F.when(ok, _cost_ms()).otherwise(F.lit(0)).cast("bigint").alias("cost_ms"),
    )


def base_rows(log: DataFrame, *carry: str, column: str = "value") -> DataFrame:
    """Log lines straight to base rows."""
    return base_projection(recharge_records(log, column), *carry)


def time_keys(records: DataFrame, *carry: str) -> DataFrame:
    request_id = F.col("request_id")
    return records.select(
        *carry,
        times.day_key(request_id).alias("day"),
        times.hour_key(request_id).alias("hour"),
        times.minute_key(request_id).alias("minute"),
        times.day_hour_key(request_id).alias("day_hour"),
        times.day_hour_minute_key(request_id).alias("day_hour_minute"),
    )


def recharge_duration(records: DataFrame, *carry: str) -> DataFrame:
    return records.select(*carry, "start_ts", "end_ts", _cost_ms().alias("duration_ms"))

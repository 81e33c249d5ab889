"""KPI aggregations over base rows.

Every one of them is a sum by key, so Spark combines on the map side and the shuffle carries one row
per key and task, however many orders a single day or province holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpitide import schemas as S

GRAINS: dict[str, list[str]] = {
    "day": ["day"],
    "hour": ["day", "hour"],
    "minute": ["day", "hour", "minute"],
    "day_province": ["day", "province_code"],
    "hour_province": ["day", "hour", "province_code"],
}
CELL_KEYS = ["day", "hour", "minute", "province_code"]


def _sum(metric: str) -> Column:
    summed = F.sum(metric)
    return (summed.cast(S.MONEY_SUM) if metric == "fee" else summed).alias(metric)


def sum_by(rows: DataFrame, keys: Sequence[str], metrics: Sequence[str] = tuple(S.METRICS)) -> DataFrame:
    """Sums of the metrics by key. Works on base rows and on rows summed before."""
    return rows.groupBy(*keys).agg(*[_sum(m) for m in metrics])


def money(name: str = "fee") -> Column:
    """The exact decimal sum as a double, for output."""
    return F.col(name).cast("double").alias("money")


def daily_success_count(rows: DataFrame) -> DataFrame:
    return sum_by(rows, ["day"], ["succ"])


def daily_success_amount(rows: DataFrame) -> DataFrame:
    return sum_by(rows, ["day"], ["fee"]).select("day", money())


def daily_success_duration(rows: DataFrame) -> DataFrame:
    return sum_by(rows, ["day"], ["cost_ms"])


def total_orders(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("orders"))


def daily_overview(rows: DataFrame) -> DataFrame:
    totals = sum_by(rows, ["day"], ["orders", "succ", "fee", "cost_ms"])
    return totals.select("day", "orders", "succ", money(), "cost_ms")


def hourly(rows: DataFrame) -> DataFrame:
    return sum_by(rows, ["day", "hour"], ["orders", "succ"])


def hourly_money(rows: DataFrame) -> DataFrame:
    return sum_by(rows, ["day", "hour"], ["orders", "succ", "fee"]).select("day", "hour", "orders", "succ", money())


def province_success(rows: DataFrame) -> DataFrame:
    return sum_by(rows, ["day", "province_code"], ["succ"])


def province_failure(rows: DataFrame) -> DataFrame:
    return sum_by(rows, ["day", "province_code"], ["orders", "fail"])


def minute(rows: DataFrame) -> DataFrame:
    return sum_by(rows, ["day", "hour", "minute"], ["succ", "fee"]).select("day", "hour", "minute", "succ", money())


def hour_province(rows: DataFrame) -> DataFrame:
    totals = sum_by(rows, ["day", "hour", "province_code"], ["orders", "succ", "fee", "cost_ms"])
    return totals.select("day", "hour", "province_code", "orders", "succ", money(), "cost_ms")


def daily_ratios(rows: DataFrame) -> DataFrame:
    """Overview with the success rate and the mean duration of a success, NULL where there is none to divide by."""
    totals = sum_by(rows, ["day"], ["orders", "succ", "fee", "cost_ms"])

    def ratio(part: str, whole: str) -> Column:
        return F.col(part).cast("double") / F.nullif(F.col(whole), F.lit(0)).cast("double")

    return totals.select(
        "day",
        "orders",
        "succ",
        money(),
        ratio("succ", "orders").alias("success_rate"),
        ratio("cost_ms", "succ").alias("mean_cost_ms"),
    )


def all_grains(rows: DataFrame, *extra: str) -> DataFrame:
    """All KPI grains from one pass over the rows, as cells with a ``grain`` column.

    The rows are summed to the finest cells first; grouping sets, which copy each input row once
    per grain, then run on those few cells instead of on every order. ``extra`` keys go into every grain.
    """
    finest = sum_by(rows, [*extra, *CELL_KEYS])
    keys = [*extra, *CELL_KEYS]
    sets = [[F.col(k) for k in (*extra, *grain)] for grain in GRAINS.values()]
    grouped = finest.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id(*[F.col(k) for k in keys]).alias("_gid"), *[_sum(m) for m in S.METRICS]
    )
    named = F.lit(None).cast("string")
    for name, grain in GRAINS.items():
        gid = sum(1 << (len(CELL_KEYS) - 1 - i) for i, key in enumerate(CELL_KEYS) if key not in grain)
        named = F.when(F.col("_gid") == gid, F.lit(name)).otherwise(named)
    return grouped.select(*extra, named.alias("grain"), *CELL_KEYS, *S.METRICS)


def of_grain(cells: DataFrame, grain: str) -> DataFrame:
    """The cells of one grain, ready for the KPI functions above."""
    return cells.where(F.col("grain") == grain)


def window_totals(rows: DataFrame, width: str) -> DataFrame:
    """Sums by tumbling window of the order's own start time. Takes streams, with or without a watermark."""
    window = F.window("start_ts", width)
    totals = rows.groupBy(window).agg(_sum("orders"), _sum("succ"), _sum("fee"))
    return totals.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "orders", "succ", money()
    )


def window_sums(rows: DataFrame, width: str) -> DataFrame:
    """``window_totals`` with exact amounts, for sums that go on adding up. The windows are those of the times as they are, in UTC."""
    totals = rows.groupBy(F.window("start_ts", width).alias("window")).agg(_sum("orders"), _sum("succ"), _sum("fee"))
    bounds = [F.col(f"window.{at}").alias(f"window_{at}") for at in ("start", "end")]
    return totals.select(*bounds, "orders", "succ", "fee")


def batch_totals(rows: DataFrame) -> DataFrame:
    """Daily sums of each batch by itself."""
    totals = sum_by(rows, ["batch_id", "day"], ["succ", "fee", "cost_ms"])
    return totals.select("batch_id", "day", "succ", money(), "cost_ms")


def running(rows: DataFrame) -> DataFrame:
    """The daily overview as it stands after each batch.

    The window runs over one row per day and batch, not over orders.
    """
    per_batch = sum_by(rows, ["day", "batch_id"], ["orders", "succ", "fee", "cost_ms"])
    so_far = Window.partitionBy("day").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_batch.select(
        "day",
        "batch_id",
        F.sum("orders").over(so_far).alias("orders"),
        F.sum("succ").over(so_far).alias("succ"),
        F.sum("fee").over(so_far).cast("double").alias("money"),
        F.sum("cost_ms").over(so_far).alias("cost_ms"),
    )


def truncated_amounts(rows: DataFrame) -> DataFrame:
    """Money per minute with each batch's sum cut to a whole number before adding, next to the exact sum."""
    keys = ["day", "hour", "minute"]
    per_batch = sum_by(rows, [*keys, "batch_id"], ["fee"])
    return per_batch.groupBy(*keys).agg(
        F.sum(F.col("fee").cast("bigint")).alias("money_truncated"),
        F.sum("fee").cast("double").alias("money"),
    )

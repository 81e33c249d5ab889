"""KPI cells as key, field and value, and what later writes do to a key: add, overwrite, expire."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpitide import schemas as S
from kpitide.operators import kpi
from kpitide.operators.lookup import with_province_name

# Key prefixes and field names of the stored KPIs.
OVERVIEW_PREFIX = "A-"
HOUR_PREFIX = "B-"
PROVINCE_PREFIX = "C-"
MINUTE_PREFIX = "D-"
TOTAL_FIELD = "total"
SUCC_FIELD = "succ"
MONEY_FIELD = "money"
COST_FIELD = "cost"
MINUTE_COUNT_FIELD = "Province"
MINUTE_MONEY_FIELD = "salary"

# Key prefixes of the overwritten KPIs.
LAST_TOTAL_PREFIX = "totalA-"
LAST_HOUR_PREFIX = "everyhour_succB-"
LAST_PROVINCE_PREFIX = "P-every_succNum"
LAST_MINUTE_PREFIX = "succ_everyminC-"

# Seconds a key lives after its last write, in the two kinds of job.
DAY_TTL = 24 * 60 * 60
TWO_DAY_TTL = 48 * 60 * 60


def _field(name: Column, value: Column, whole: bool = True) -> Column:
    number = value.cast(S.MONEY_SUM)
    text = value.cast("string") if whole else number.cast("string")
    return F.struct(name.alias("field"), number.alias("number"), text.alias("value"))


def key_value(cells: DataFrame, *carry: str) -> DataFrame:
    """``key, field, number, value`` rows of the stored KPIs; ``value`` is the number as text."""
    named = with_province_name(cells.where(F.col("grain") != "hour_province"))
    c = F.col
    hour_minute = F.concat("hour", "minute")
    grain = c("grain")
    prefix = (
        F.when(grain == "day", OVERVIEW_PREFIX)
        .when(grain == "hour", HOUR_PREFIX)
        .when(grain == "day_province", PROVINCE_PREFIX)
        .otherwise(MINUTE_PREFIX)
    )
    overview = F.array(
        _field(F.lit(TOTAL_FIELD), c("orders")),
        _field(F.lit(SUCC_FIELD), c("succ")),
        _field(F.lit(MONEY_FIELD), c("fee"), whole=False),
        _field(F.lit(COST_FIELD), c("cost_ms")),
    )
    hour = F.array(
        _field(F.concat(F.lit(TOTAL_FIELD), "hour"), c("orders")),
        _field(F.concat(F.lit(SUCC_FIELD), "hour"), c("succ")),
        _field(F.concat(F.lit(MONEY_FIELD), "hour"), c("fee"), whole=False),
    )
    province = F.array(_field(c("province"), c("fail")))
    minute = F.array(
        _field(F.concat(F.lit(MINUTE_COUNT_FIELD), hour_minute), c("succ")),
        _field(F.concat(F.lit(MINUTE_MONEY_FIELD), hour_minute), c("fee"), whole=False),
    )
    fields = (
        F.when(grain == "day", overview)
        .when(grain == "hour", hour)
        .when(grain == "day_province", province)
        .otherwise(minute)
    )
    return named.select(*carry, F.concat(prefix, c("day")).alias("key"), F.inline(fields))


def accumulate(partials: DataFrame) -> DataFrame:
    """Cumulative value per key and field over the partial values of all batches."""
    return partials.groupBy("key", "field").agg(F.sum("number").cast("double").alias("value"))


def success_counter(rows: DataFrame, prefix: str) -> DataFrame:
    """One counter per day under ``prefix`` + day."""
    counts = kpi.daily_success_count(rows)
    return counts.select(F.concat(F.lit(prefix), "day").alias("key"), F.col("succ").alias("value"))


def last_value(df: DataFrame, keys: Sequence[str], values: Sequence[str], version: str = "batch_id") -> DataFrame:
    """The values of the newest version of each key: what overwriting leaves behind."""
    return df.groupBy(*keys).agg(
        F.max(version).alias(version), *[F.max_by(v, version).alias(v) for v in values]
    )


def last_batch_kpis(cells: DataFrame) -> DataFrame:
    """Overwritten KPIs: per key the sums of the last batch that wrote it, not a running total."""
    grain = F.col("grain")
    key = (
        F.when(grain == "day", F.concat(F.lit(LAST_TOTAL_PREFIX), "day"))
        .when(grain == "hour", F.concat(F.lit(LAST_HOUR_PREFIX), "day", "hour"))
        .when(grain == "minute", F.concat(F.lit(LAST_MINUTE_PREFIX), "day", "hour", "minute"))
        .when(grain == "hour_province", F.concat(F.lit(LAST_PROVINCE_PREFIX), "day", "hour", F.lit("-"), "province_code"))
    )
    keyed = cells.where(grain != "day_province").select(
        key.alias("key"), "batch_id", "orders", "succ", kpi.money(), "cost_ms"
    )
    return last_value(keyed, ["key"], ["orders", "succ", "money", "cost_ms"])


def _seconds(ttl: int) -> Column:
    return F.make_dt_interval(secs=F.lit(ttl))


def current_segment(partials: DataFrame, keys: Sequence[str], ttl: int, time: str = "write_time") -> DataFrame:
    """The partials a key still holds, with ``segment_start`` and ``expires_at``.

    A write to any field renews the whole key for ``ttl`` seconds. A write after that finds the key
    gone and starts afresh, so only the writes since the last such gap count. The windows share one
    shuffle. They are for partials with one row per key and batch; ``held_cells`` is for many.
    """
    previous = F.lag(time).over(Window.partitionBy(*keys).orderBy(time))
    begins = previous.isNull() | (F.col(time) >= previous + _seconds(ttl))
    of_key = Window.partitionBy(*keys)
    return (
        partials.withColumn("_begins", F.when(begins, F.col(time)))
        .withColumn("segment_start", F.max("_begins").over(of_key))
        .withColumn("expires_at", F.max(time).over(of_key) + _seconds(ttl))
        .where(F.col(time) >= F.col("segment_start"))
        .drop("_begins")
    )


def held_cells(cells: DataFrame, keys: Sequence[str], ttl: int, time: str = "write_time") -> DataFrame:
    """``current_segment`` of stored cells, of which a key has many per batch: the windows run over its distinct write times."""
    times = current_segment(cells.select(*keys, time).distinct(), keys, ttl, time)
    segments = times.select(*keys, "segment_start", "expires_at").distinct()
    inside = F.col(time) >= F.col("segment_start")
    return cells.join(segments, list(keys)).where(inside).select(*cells.columns, "segment_start", "expires_at")


def alive_at(partials: DataFrame, keys: Sequence[str], ttl: int, as_of: Column, time: str = "write_time") -> DataFrame:
    """The partials of the keys that are alive at ``as_of``, counting only what was written by then."""
    written = partials.where(F.col(time) <= as_of)
    return current_segment(written, keys, ttl, time).where(F.col("expires_at") > as_of)

"""Queries over the recharge log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpitide.operators import keyed, kpi
from kpitide.operators import parse as P
from kpitide.operators import project
from kpitide.operators.lookup import with_province_name
from kpitide.plans.fixture_sql import BASE, LOG, PROVINCE, RECHARGE, money, total
from kpitide.plans.registry import Query
from kpitide.sources import tables

AS_OF = "2024-01-20 12:00:00"
RESTART_TTL = 20 * 60
COUNTER_PREFIX = "SUCC-"


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.recharge_log(tables.table(spark, sf_dir, "events"))


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.base_rows(log(spark, sf_dir), "seq", "batch_id")


def batch_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of all grains of each batch."""
    return kpi.all_grains(base(spark, sf_dir), "batch_id")


def _on_base(operator: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: operator(base(spark, sf_dir))


def parse_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = P.parse_log(log(spark, sf_dir))
    fee = P.amount(F.col("chargefee")).cast("double").alias("fee")
    return parsed.select("seq", *[c for c in P.PARSED_COLUMNS if c != "chargefee"], fee)


def parse_log_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = P.parse_log_variant(log(spark, sf_dir))
    fee = P.amount(F.col("chargefee")).cast("double").alias("fee")
    return parsed.select("seq", *[c for c in P.PARSED_COLUMNS if c != "chargefee"], fee)


def rejected_records_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.rejected_records(tables.damaged_log(tables.table(spark, sf_dir, "events")), parse=P.parse_log_variant)


def filter_recharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.filter_recharge(P.parse_log(log(spark, sf_dir))).select("seq", "service_name", "request_id")


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.rejected_records(tables.damaged_log(tables.table(spark, sf_dir, "events")))


def damaged_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = tables.damaged_log(tables.table(spark, sf_dir, "events"))
    return kpi.daily_overview(project.base_rows(damaged))


def base_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).drop("batch_id").withColumn("fee", F.col("fee").cast("double"))


def time_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.time_keys(P.recharge_records(log(spark, sf_dir)), "seq")


def recharge_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.recharge_duration(P.recharge_records(log(spark, sf_dir)), "seq")


def province_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_province_name(base(spark, sf_dir)).select("seq", "province_code", "province")


def kpi_province_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_province_name(kpi.province_success(base(spark, sf_dir))).select("day", "province", "succ")


def kpi_province_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_province_name(kpi.province_failure(base(spark, sf_dir))).select("day", "province", "orders", "fail")


def kpi_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.all_grains(base(spark, sf_dir)).withColumn("fee", F.col("fee").cast("double"))


def kpi_key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.key_value(kpi.all_grains(base(spark, sf_dir))).drop("number")


def kpi_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.accumulate(keyed.key_value(batch_cells(spark, sf_dir), "batch_id"))


def kpi_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.last_batch_kpis(batch_cells(spark, sf_dir))


def daily_success_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.success_counter(base(spark, sf_dir), COUNTER_PREFIX)


def _daily_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = kpi.sum_by(base(spark, sf_dir), ["day", "batch_id"])
    return partials.withColumn("write_time", tables.write_time())


def _day_totals(held: DataFrame, *extra: str) -> DataFrame:
    totals = kpi.sum_by(held, ["day", "expires_at", *extra], ["orders", "succ", "fee", "cost_ms"])
    return totals.select("day", *extra, "expires_at", "orders", "succ", kpi.money(), "cost_ms")


def kpi_ttl_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.to_timestamp_ntz(F.lit(AS_OF))
    return _day_totals(keyed.alive_at(_daily_partials(spark, sf_dir), ["day"], keyed.TWO_DAY_TTL, as_of))


def kpi_ttl_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = keyed.current_segment(_daily_partials(spark, sf_dir), ["day"], RESTART_TTL)
    return _day_totals(held, "segment_start")


def _window(width: str):
    return lambda spark, sf_dir: kpi.window_totals(base(spark, sf_dir), width)


def _by(keys: str, *columns: str) -> str:
    picked = ", ".join([keys, *columns])
    return f"WITH {BASE} SELECT {picked} FROM base GROUP BY {keys}"


def window_sql(unit: str) -> str:
    return f"""WITH {BASE}
    SELECT date_trunc('{unit}', start_ts) AS window_start, date_trunc('{unit}', start_ts) + INTERVAL 1 {unit} AS window_end,
           {total('orders')}, {total('succ')}, {money()}
    FROM base GROUP BY ALL"""


_SPOILT = f"""{LOG},
spoilt AS (
  SELECT *, seq % 16 AS kind, service_name AS sn, result AS rs, CAST(amount AS VARCHAR) AS fe, province_code AS pc,
         CASE seq % 16 WHEN 3 THEN substr(request_id, 1, 16) WHEN 4 THEN '20241301' || substr(request_id, 9)
              ELSE request_id END AS rid,
         CASE seq % 16 WHEN 7 THEN 'soon' ELSE receive_time END AS rt
  FROM log
),
texts AS (
  SELECT *, CASE kind WHEN 6 THEN '' WHEN 0 THEN substr(text, 1, 40) WHEN 8 THEN text || ' ' || text
              WHEN 9 THEN chr(10) || chr(9) || text || chr(9) || chr(13) || chr(10) ELSE text END AS value
  FROM (
    SELECT *, '{{' || CASE kind WHEN 1 THEN '' ELSE '"serviceName":"' || sn || '",' END
              || CASE kind WHEN 2 THEN '' ELSE '"bussinessRst":"' || rs || '",' END
              || '"chargefee":"' || CASE kind WHEN 5 THEN 'abc' ELSE fe END || '","provinceCode":"' || pc
              || '","requestId":"' || rid || '","receiveNotifyTime":"' || rt || '"}}' AS text
    FROM spoilt) AS whole
),
reasons AS (
  SELECT *, CASE
      WHEN kind = 6 THEN 'empty' WHEN kind IN (0, 8) THEN 'bad_json' WHEN kind = 1 THEN 'missing_service_name'
      WHEN lower(service_name) <> 'rechargenotifyreq' THEN NULL
      WHEN kind = 2 THEN 'missing_result' WHEN kind = 3 THEN 'bad_request_id' WHEN kind = 4 THEN 'bad_start_time'
      WHEN kind = 5 THEN 'bad_fee' WHEN kind = 7 THEN 'bad_receive_time' END AS reason
  FROM texts
)"""

_METRIC_SUMS = ", ".join([total("orders"), total("succ"), total("fail"), "CAST(sum(fee) AS DOUBLE) AS fee", total("cost_ms")])
_GRAIN_SETS = "(day), (day, hour), (day, hour, minute), (day, province_code), (day, hour, province_code)"
_GRAIN_NAME = """CASE WHEN grouping(province_code) = 0 AND grouping(hour) = 0 THEN 'hour_province'
            WHEN grouping(province_code) = 0 THEN 'day_province' WHEN grouping(minute) = 0 THEN 'minute'
            WHEN grouping(hour) = 0 THEN 'hour' ELSE 'day' END"""


def grouping_sets_sql() -> str:
    return f"""WITH {BASE}
    SELECT {_GRAIN_NAME} AS grain, day, hour, minute, province_code, {_METRIC_SUMS}
    FROM base GROUP BY GROUPING SETS ({_GRAIN_SETS})"""


_STORED = f"""{BASE}, {PROVINCE},
sums AS (
  SELECT {_GRAIN_NAME} AS grain, day, hour, minute, coalesce(max(name), province_code) AS province,
         sum(orders) AS orders, sum(succ) AS succ, sum(fail) AS fail, sum(fee) AS fee, sum(cost_ms) AS cost_ms
  FROM base LEFT JOIN province ON code = province_code
  GROUP BY GROUPING SETS ({_GRAIN_SETS})
),
stored AS (
  SELECT 'A-' || day AS key, 'total' AS field, CAST(orders AS VARCHAR) AS value FROM sums WHERE grain = 'day'
  UNION ALL SELECT 'A-' || day, 'succ', CAST(succ AS VARCHAR) FROM sums WHERE grain = 'day'
  UNION ALL SELECT 'A-' || day, 'money', CAST(fee AS VARCHAR) FROM sums WHERE grain = 'day'
  UNION ALL SELECT 'A-' || day, 'cost', CAST(cost_ms AS VARCHAR) FROM sums WHERE grain = 'day'
  UNION ALL SELECT 'B-' || day, 'total' || hour, CAST(orders AS VARCHAR) FROM sums WHERE grain = 'hour'
  UNION ALL SELECT 'B-' || day, 'succ' || hour, CAST(succ AS VARCHAR) FROM sums WHERE grain = 'hour'
  UNION ALL SELECT 'B-' || day, 'money' || hour, CAST(fee AS VARCHAR) FROM sums WHERE grain = 'hour'
  UNION ALL SELECT 'C-' || day, province, CAST(fail AS VARCHAR) FROM sums WHERE grain = 'day_province'
  UNION ALL SELECT 'D-' || day, 'Province' || hour || minute, CAST(succ AS VARCHAR) FROM sums WHERE grain = 'minute'
  UNION ALL SELECT 'D-' || day, 'salary' || hour || minute, CAST(fee AS VARCHAR) FROM sums WHERE grain = 'minute'
)"""

_LAST = f"""{BASE},
keyed AS (
  SELECT 'totalA-' || day AS key, * FROM base
  UNION ALL SELECT 'everyhour_succB-' || day || hour, * FROM base
  UNION ALL SELECT 'succ_everyminC-' || day || hour || minute, * FROM base
  UNION ALL SELECT 'P-every_succNum' || day || hour || '-' || province_code, * FROM base
)"""


def last_value_sql(batch: str = "batch_id") -> str:
    """The sums of the last batch that wrote each key."""
    return f"""WITH {_LAST} SELECT key, {batch} AS batch_id, {total('orders')}, {total('succ')}, {money()}, {total('cost_ms')}
        FROM keyed GROUP BY key, {batch} QUALIFY row_number() OVER (PARTITION BY key ORDER BY {batch} DESC) = 1"""


_TTL = f"""{BASE},
partials AS (
  SELECT day, write_time, sum(orders) AS orders, sum(succ) AS succ, sum(fee) AS fee, sum(cost_ms) AS cost_ms
  FROM base GROUP BY day, batch_id, write_time
)"""


def _segments_sql(source: str, ttl: int) -> str:
    return f"""{source},
    gaps AS (
      SELECT *, lag(write_time) OVER (PARTITION BY day ORDER BY write_time) AS previous FROM written
    ),
    numbered AS (
      SELECT *, sum(CASE WHEN previous IS NULL OR write_time >= previous + INTERVAL {ttl} SECOND THEN 1 ELSE 0 END)
                OVER (PARTITION BY day ORDER BY write_time) AS segment
      FROM gaps
    ),
    segments AS (
      SELECT day, segment, min(write_time) AS segment_start, max(write_time) + INTERVAL {ttl} SECOND AS expires_at,
             {total('orders')}, {total('succ')}, {money()}, {total('cost_ms')}
      FROM numbered GROUP BY day, segment
    ),
    newest AS (
      SELECT * FROM segments QUALIFY row_number() OVER (PARTITION BY day ORDER BY segment DESC) = 1
    )"""


_DURATION = "epoch_ms(end_ts) - epoch_ms(start_ts)"
_RATIOS = (
    "CAST(sum(succ) AS DOUBLE) / sum(orders) AS success_rate",
    "CAST(sum(cost_ms) AS DOUBLE) / nullif(CAST(sum(succ) AS DOUBLE), 0) AS mean_cost_ms",
)

QUERIES = {
    "kpi_daily_overview": Query(
        _on_base(kpi.daily_overview), _by("day", total("orders"), total("succ"), money(), total("cost_ms"))
    ),
    "parse_log": Query(
        parse_log,
        f"""WITH {LOG} SELECT seq, service_name, result, province_code, request_id, receive_time,
            CAST(amount AS DOUBLE) AS fee FROM log""",
    ),
    "filter_recharge": Query(filter_recharge, f"WITH {RECHARGE} SELECT seq, service_name, request_id FROM recharge"),
    "rejected_records": Query(
        rejected_records, f"WITH {_SPOILT} SELECT seq, value, reason FROM reasons WHERE reason IS NOT NULL"
    ),
    "rejects_left_out": Query(
        damaged_overview,
        f"""WITH {_SPOILT} SELECT substr(request_id, 1, 8) AS day, count(*) AS orders,
            count(*) FILTER (result = '0000') AS succ,
            CAST(coalesce(sum(amount) FILTER (result = '0000'), 0) AS DOUBLE) AS money,
            CAST(coalesce(sum({_DURATION}) FILTER (result = '0000'), 0) AS BIGINT) AS cost_ms
            FROM reasons WHERE reason IS NULL AND lower(service_name) = 'rechargenotifyreq' GROUP BY 1""",
    ),
    "time_keys": Query(
        time_keys,
        f"""WITH {RECHARGE} SELECT seq, substr(request_id, 1, 8) AS day, substr(request_id, 9, 2) AS hour,
            substr(request_id, 11, 2) AS minute, substr(request_id, 1, 10) AS day_hour,
            substr(request_id, 1, 12) AS day_hour_minute FROM recharge""",
    ),
    "recharge_duration": Query(
        recharge_duration,
        f"WITH {RECHARGE} SELECT seq, start_ts, end_ts, {_DURATION} AS duration_ms FROM recharge",
    ),
    "base_projection": Query(
        base_projection,
        f"""WITH {BASE} SELECT seq, request_id, province_code, result, day, hour, minute, start_ts, end_ts,
            orders, succ, fail, CAST(fee AS DOUBLE) AS fee, cost_ms FROM base""",
    ),
    "province_lookup": Query(
        province_lookup,
        f"""WITH {BASE}, {PROVINCE} SELECT seq, province_code, coalesce(name, province_code) AS province
            FROM base LEFT JOIN province ON code = province_code""",
    ),
    "daily_success_count": Query(_on_base(kpi.daily_success_count), _by("day", total("succ"))),
    "daily_success_amount": Query(_on_base(kpi.daily_success_amount), _by("day", money())),
    "daily_success_duration": Query(_on_base(kpi.daily_success_duration), _by("day", total("cost_ms"))),
    "total_orders": Query(_on_base(kpi.total_orders), f"WITH {RECHARGE} SELECT count(*) AS orders FROM recharge"),
    "kpi_hourly": Query(_on_base(kpi.hourly), _by("day, hour", total("orders"), total("succ"))),
    "kpi_hourly_money": Query(
        _on_base(kpi.hourly_money), _by("day, hour", total("orders"), total("succ"), money())
    ),
    "kpi_province_success": Query(
        kpi_province_success,
        f"""WITH {BASE}, {PROVINCE} SELECT day, coalesce(name, province_code) AS province, {total('succ')}
            FROM base LEFT JOIN province ON code = province_code GROUP BY 1, 2""",
    ),
    "kpi_province_failure": Query(
        kpi_province_failure,
        f"""WITH {BASE}, {PROVINCE} SELECT day, coalesce(name, province_code) AS province, {total('orders')},
            {total('fail')} FROM base LEFT JOIN province ON code = province_code GROUP BY 1, 2""",
    ),
    "kpi_minute": Query(_on_base(kpi.minute), _by("day, hour, minute", total("succ"), money())),
    "kpi_hour_province": Query(
        _on_base(kpi.hour_province),
        _by("day, hour, province_code", total("orders"), total("succ"), money(), total("cost_ms")),
    ),
    "kpi_daily_ratios": Query(
        _on_base(kpi.daily_ratios), _by("day", total("orders"), total("succ"), money(), *_RATIOS)
    ),
    "kpi_grouping_sets": Query(kpi_grouping_sets, grouping_sets_sql()),
    "kpi_key_value": Query(kpi_key_value, f"WITH {_STORED} SELECT key, field, value FROM stored"),
    "kpi_accumulate": Query(
        kpi_accumulate, f"WITH {_STORED} SELECT key, field, CAST(CAST(value AS DECIMAL(28,2)) AS DOUBLE) AS value FROM stored"
    ),
    "kpi_last_value": Query(
        kpi_last_value,
        last_value_sql(),
    ),
    "daily_success_counter": Query(
        daily_success_counter,
        f"""WITH {BASE} SELECT '{COUNTER_PREFIX}' || day AS key, CAST(sum(succ) AS BIGINT) AS value
            FROM base GROUP BY day""",
    ),
    "kpi_ttl_live": Query(
        kpi_ttl_live,
        "WITH "
        + _segments_sql(
            f"{_TTL}, written AS (SELECT * FROM partials WHERE write_time <= TIMESTAMP '{AS_OF}')", keyed.TWO_DAY_TTL
        )
        + f"""SELECT day, expires_at, orders, succ, money, cost_ms FROM newest
              WHERE expires_at > TIMESTAMP '{AS_OF}'""",
    ),
    "kpi_ttl_restart": Query(
        kpi_ttl_restart,
        "WITH "
        + _segments_sql(f"{_TTL}, written AS (SELECT * FROM partials)", RESTART_TTL)
        + "SELECT day, segment_start, expires_at, orders, succ, money, cost_ms FROM newest",
    ),
    "per_batch_totals": Query(
        _on_base(kpi.batch_totals), _by("batch_id, day", total("succ"), money(), total("cost_ms"))
    ),
    "kpi_running": Query(
        _on_base(kpi.running),
        f"""WITH {BASE}
            SELECT day, batch_id, CAST(sum(orders) OVER so_far AS BIGINT) AS orders,
                   CAST(sum(succ) OVER so_far AS BIGINT) AS succ, CAST(sum(fee) OVER so_far AS DOUBLE) AS money,
                   CAST(sum(cost_ms) OVER so_far AS BIGINT) AS cost_ms
            FROM (SELECT day, batch_id, sum(orders) AS orders, sum(succ) AS succ, sum(fee) AS fee,
                         sum(cost_ms) AS cost_ms FROM base GROUP BY day, batch_id) AS per_batch
            WINDOW so_far AS (PARTITION BY day ORDER BY batch_id)""",
    ),
    "truncated_amounts": Query(
        _on_base(kpi.truncated_amounts),
        f"""WITH {BASE}
            SELECT day, hour, minute, CAST(sum(trunc(fee)) AS BIGINT) AS money_truncated, {money()}
            FROM (SELECT day, hour, minute, batch_id, sum(fee) AS fee FROM base GROUP BY ALL) AS per_batch
            GROUP BY day, hour, minute""",
    ),
    "kpi_minute_window": Query(_window("1 minute"), window_sql("minute")),
    "kpi_hour_window": Query(_window("1 hour"), window_sql("hour")),
    "kpi_day_window": Query(_window("1 day"), window_sql("day")),
}
QUERIES["parse_log_variant"] = Query(parse_log_variant, QUERIES["parse_log"].sql)
QUERIES["rejected_records_variant"] = Query(rejected_records_variant, QUERIES["rejected_records"].sql)

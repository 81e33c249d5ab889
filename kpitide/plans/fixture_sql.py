"""The derived inputs in SQL, for the oracle: computed from the tables, not through JSON or Spark."""

from __future__ import annotations

from kpitide import schemas as S
from kpitide.sources.tables import BATCH_MINUTES, RECORD_PARTITIONS, UNKNOWN_CODES

_CODES = ", ".join(f"'{c}'" for c in [code for code, _ in S.PROVINCES] + UNKNOWN_CODES)
_BATCH = f"epoch_us(ts) // ({BATCH_MINUTES} * 60000000)"
_COMPACT = "'%Y%m%d%H%M%S%g'"

LOG = f"""
log AS (
  SELECT event_id AS seq, {_BATCH} AS batch_id,
         make_timestamp(({_BATCH} + 1) * {BATCH_MINUTES} * 60000000) AS write_time,
         CASE event_type WHEN 'view' THEN 'sendRechargeReq' WHEN 'click' THEN 'RECHARGENOTIFYREQ'
              ELSE 'reChargeNotifyReq' END AS service_name,
         CASE event_type WHEN 'error' THEN '0001' ELSE '0000' END AS result,
         CAST(value AS DECIMAL(18,2)) AS amount,
         [{_CODES}][user_id % 33 + 1] AS province_code,
         strftime(ts, {_COMPACT}) || lpad(CAST(event_id AS VARCHAR), 15, '0') AS request_id,
         strftime(ts + to_milliseconds(CAST(trunc(value * 100) AS BIGINT)), {_COMPACT}) AS receive_time,
         date_trunc('millisecond', ts) AS start_ts,
         date_trunc('millisecond', ts + to_milliseconds(CAST(trunc(value * 100) AS BIGINT))) AS end_ts
  FROM events
)"""

RECHARGE = f"""{LOG},
recharge AS (
  SELECT * FROM log WHERE lower(service_name) = 'rechargenotifyreq'
)"""

BASE = f"""{RECHARGE},
base AS (
  SELECT seq, batch_id, write_time, request_id, province_code, result,
         substr(request_id, 1, 8) AS day, substr(request_id, 9, 2) AS hour, substr(request_id, 11, 2) AS minute,
         start_ts, end_ts, CAST(1 AS BIGINT) AS orders,
         CAST(result = '0000' AS BIGINT) AS succ, CAST(result <> '0000' AS BIGINT) AS fail,
         CASE WHEN result = '0000' THEN amount ELSE 0 END AS fee,
         CASE WHEN result = '0000' THEN epoch_ms(end_ts) - epoch_ms(start_ts) ELSE 0 END AS cost_ms
  FROM recharge
)"""

_NAMES = ", ".join(f"('{code}', '{name}')" for code, name in S.PROVINCES)
PROVINCE = f"""
province AS (
  SELECT * FROM (VALUES {_NAMES}) AS t(code, name)
)"""

RECORDS = f"""
records AS (
  SELECT event_type AS topic, CAST(user_id % {RECORD_PARTITIONS} AS INTEGER) AS partition, event_id AS "offset",
         props AS msg, {_BATCH} AS batch_id, ts
  FROM events
)"""

LINES = """
turns AS (
  SELECT conv_id, turn, string_split(text, chr(10)) AS parts FROM conversations
),
lines AS (
  SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS line, parts[i] AS value
  FROM (SELECT conv_id, turn, parts, unnest(range(1, len(parts) + 1)) AS i FROM turns) AS numbered
)"""


def tokens(delimiter: str = " ") -> str:
    """Tokens of the lines: trailing empty ones dropped, and one empty token for an empty line."""
    return f"""{LINES},
split_lines AS (
  SELECT conv_id, turn, line,
         CASE WHEN value = '' THEN [''] WHEN rtrim(value, '{delimiter}') = '' THEN []
              ELSE string_split(rtrim(value, '{delimiter}'), '{delimiter}') END AS words
  FROM lines
),
tokens AS (
  SELECT conv_id, turn, line, CAST(i - 1 AS INTEGER) AS pos, words[i] AS word
  FROM (SELECT conv_id, turn, line, words, unnest(range(1, len(words) + 1)) AS i FROM split_lines) AS numbered
)"""


def total(column: str) -> str:
    """A whole-number sum; the bare one is wider than the BIGINT the queries give."""
    return f"CAST(sum({column}) AS BIGINT) AS {column}"


def money(column: str = "fee") -> str:
    return f"CAST(sum({column}) AS DOUBLE) AS money"

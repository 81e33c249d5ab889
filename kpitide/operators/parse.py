"""JSON log lines to checked recharge records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpitide import schemas as S
from kpitide.functions import times
from kpitide.functions.text import equals_ignore_case

PARSED_COLUMNS = {
    "service_name": S.SERVICE_NAME,
    "result": S.RESULT,
    "chargefee": S.FEE,
    "province_code": S.PROVINCE_CODE,
    "request_id": S.REQUEST_ID,
    "receive_time": S.RECEIVE_TIME,
}

TIME_COLUMNS = ["start_no", "end_no", "start_ts", "end_ts", "amount"]


# White space of JSON, which may stand around an object.
JSON_BLANKS = " \t\r\n"


def _trimmed(value: Column) -> Column:
    return F.btrim(value, F.lit(JSON_BLANKS))


def _is_object(value: Column) -> Column:
    trimmed = _trimmed(value)
    return trimmed.startswith("{") & trimmed.endswith("}")


def drop_empty(df: DataFrame, column: str = "value") -> DataFrame:
    return df.where(F.length(column) > 0)


def parse_log(df: DataFrame, column: str = "value") -> DataFrame:
    """Add one column per record field, and ``_corrupt``, to the other columns. A line that is no object has no fields.

    The JSON reader accepts text after an object, so the line is read as the list of one object that it should be.

    The record goes through ``inline``: filters on the fields then stay above the parse. On plain
    struct columns the optimizer moves a copy of ``from_json`` into each filter and parses a line several times.
    """
    listed = F.concat(F.lit(f'{{"{S.LISTED}":['), F.col(column), F.lit("]}"))
    text = F.when(_is_object(F.col(column)), listed)
    record = F.from_json(text, S.RECHARGE_PARSE_SCHEMA, {"columnNameOfCorruptRecord": S.CORRUPT})
    parsed = df.select("*", F.inline(F.array(record)))
    one = F.size(S.LISTED) == 1
    fields = [F.when(one, F.get(S.LISTED, F.lit(0))[field]).alias(name) for name, field in PARSED_COLUMNS.items()]
    corrupt = F.when(one, F.col(S.CORRUPT)).otherwise(F.col(column)).alias(S.CORRUPT)
    return parsed.select(*df.columns, *fields, corrupt)


def parse_log_variant(df: DataFrame, column: str = "value") -> DataFrame:
    """``parse_log`` through a VARIANT: the line is parsed without a schema, and fields are taken out by path.

    A number is given as text in its shortest form, so 1.50 is 1.5.
    """
    listed = F.concat(F.lit("["), F.col(column), F.lit("]"))
    parsed = F.when(_is_object(F.col(column)), F.try_parse_json(listed))
    held = df.select("*", F.inline(F.array(F.struct(parsed.alias("_parsed")))))
    one = F.try_variant_get("_parsed", "$[0]", "variant").isNotNull() & F.try_variant_get("_parsed", "$[1]", "variant").isNull()
    fields = [F.when(one, F.try_variant_get("_parsed", f"$[0].{field}", "string")).alias(name) for name, field in PARSED_COLUMNS.items()]
    return held.select(*df.columns, *fields, F.when(~F.coalesce(one, F.lit(False)), F.col(column)).alias(S.CORRUPT))


def amount(chargefee: Column) -> Column:
    """Money from text, to two decimals; NULL if it is no number."""
    return F.nullif(chargefee, F.lit("")).try_cast(S.MONEY)


def filter_recharge(parsed: DataFrame) -> DataFrame:
    """Keep the recharge notifications."""
    return parsed.where(equals_ignore_case(F.col("service_name"), S.RECHARGE_SERVICE))


def _may_be_recharge(value: Column) -> Column:
    """False only if the line cannot be a recharge notification, so that other kinds of record need no parse.

    The name of the kind stands in the line as it is, in some case, unless the line has escaped letters.
    """
    return F.lower(value).contains(S.RECHARGE_SERVICE.lower()) | value.contains("\\u")


def with_times(records: DataFrame) -> DataFrame:
    """Add ``start_ts`` and ``end_ts``, both times also as numbers, and ``amount``.

    They go through ``inline`` as well: the check and the projection after it use them several times, and
    in place they would be computed each time.
    """
    start, end = F.col("start_no"), F.col("end_no")
    numbers = F.struct(
        times.compact_number(F.col("request_id")).alias("start_no"),
        times.compact_number(F.col("receive_time")).alias("end_no"),
        amount(F.col("chargefee")).alias("amount"),
    )
    stamps = F.struct(
        times.number_to_timestamp(start).alias("start_ts"), times.number_to_timestamp(end).alias("end_ts")
    )
    return records.select("*", F.inline(F.array(numbers))).select("*", F.inline(F.array(stamps)))


def _field_problem() -> Column:
    """Why a recharge notification cannot be counted; NULL if it can. A missing fee matters only on success."""
    no_fee = F.nullif(F.col("chargefee"), F.lit("")).isNull()
    return (
        F.when(F.col("result").isNull(), "missing_result")
        .when(F.col("province_code").isNull(), "missing_province")
        .when(F.col("start_no").isNull(), "bad_request_id")
        .when(F.col("start_ts").isNull(), "bad_start_time")
        .when(F.col("end_ts").isNull(), "bad_receive_time")
        .when(no_fee & (F.col("result") == S.SUCCESS), "missing_fee")
        .when(~no_fee & F.col("amount").isNull(), "bad_fee")
    )


def with_reason(parsed: DataFrame, column: str = "value") -> DataFrame:
    """Add ``reason``: why the line is rejected, or NULL for good lines and for other kinds of record."""
    value = F.col(column)
    reason = (
        F.when(value.isNull() | (_trimmed(value) == ""), "empty")
        .when(~_is_object(value) | F.col(S.CORRUPT).isNotNull(), "bad_json")
        .when(F.col("service_name").isNull(), "missing_service_name")
        .when(equals_ignore_case(F.col("service_name"), S.RECHARGE_SERVICE), _field_problem())
    )
    return with_times(parsed).withColumn("reason", reason)


#: Why a line cannot be counted.
REASONS = [
    "empty",
    "bad_json",
    "missing_service_name",
    "missing_result",
    "missing_province",
    "bad_request_id",
    "bad_start_time",
    "bad_receive_time",
    "missing_fee",
    "bad_fee",
]


def checked_records(df: DataFrame, column: str = "value") -> DataFrame:
    """The notifications and the lines that cannot be counted, from one parse: the columns of ``with_reason``, and the line itself in ``_line``
    where there is a reason. Other kinds of record are left out.
    """
    line = F.struct(*[F.col(c) for c in df.columns])
    checked = with_reason(parse_log(df, column), column).withColumn("_line", F.when(F.col("reason").isNotNull(), line))
    return checked.where(F.col("reason").isNotNull() | equals_ignore_case(F.col("service_name"), S.RECHARGE_SERVICE))


def rejected_records(df: DataFrame, column: str = "value", parse: Callable[[DataFrame, str], DataFrame] = parse_log) -> DataFrame:
    """The lines that cannot be counted, with the reason."""
    checked = with_reason(parse(df, column), column).where(F.col("reason").isNotNull())
    return checked.drop(*PARSED_COLUMNS, *TIME_COLUMNS, S.CORRUPT)


def recharge_records(df: DataFrame, column: str = "value") -> DataFrame:
    """The recharge notifications that can be counted, with the columns of ``with_times``."""
    possible = df.where(_may_be_recharge(F.col(column)))
    kept = filter_recharge(parse_log(possible, column)).where(F.col(S.CORRUPT).isNull())
    return with_times(kept).where(_field_problem().isNull()).drop(S.CORRUPT)

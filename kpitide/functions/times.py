"""Keys, timestamps and durations from compact ``yyyyMMddHHmmssSSS`` text."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPACT_LENGTH = 17


def day_key(compact: Column) -> Column:
    return F.substring(compact, 1, 8)


def hour_key(compact: Column) -> Column:
    return F.substring(compact, 9, 2)


def minute_key(compact: Column) -> Column:
    return F.substring(compact, 11, 2)


def day_hour_key(compact: Column) -> Column:
    return F.substring(compact, 1, 10)


def day_hour_minute_key(compact: Column) -> Column:
    return F.substring(compact, 1, 12)


def compact_number(text: Column) -> Column:
    """The first 17 characters as a number; NULL unless all of them are digits.

    17 characters whose value has 17 digits hold no sign, blank or letter. This is quicker than a
    regular expression, and date and time are then plain arithmetic.
    """
    number = F.substring(text, 1, COMPACT_LENGTH).try_cast("bigint")
    return F.when(number >= 10 ** (COMPACT_LENGTH - 1), number)


def _digits(number: Column, drop: int, keep: int) -> Column:
    """``keep`` digits of the number, left of the last ``drop`` ones."""
    shifted = number if drop == 0 else F.call_function("div", number, F.lit(10**drop))
    return (shifted % 10**keep).cast("int")


def number_to_timestamp(number: Column) -> Column:
    """Timestamp without time zone of a compact number; NULL if there is no such time."""
    millis = number % 100_000
    # A 60th second would be taken as the next minute.
    seconds = F.when(millis < 60_000, millis.cast("decimal(5,0)") * F.lit(Decimal("0.001")))
    return F.try_make_timestamp_ntz(
        _digits(number, 13, 4),
        _digits(number, 11, 2),
        _digits(number, 9, 2),
        _digits(number, 7, 2),
        _digits(number, 5, 2),
        seconds.cast("decimal(16,6)"),
    )


def millis_of(timestamp: Column, number: Column) -> Column:
    """Milliseconds since the epoch of a compact number whose timestamp is known.

    It is read as UTC whatever the session time zone is.
    """
    whole_days = F.unix_date(timestamp.cast("date")).cast("bigint") * 86_400_000
    hours = _digits(number, 7, 2) * 3_600_000
    minutes = _digits(number, 5, 2) * 60_000
    return whole_days + hours + minutes + number % 100_000


def compact_to_timestamp(text: Column) -> Column:
    return number_to_timestamp(compact_number(text))


def compact_to_millis(text: Column) -> Column:
    number = compact_number(text)
    return millis_of(number_to_timestamp(number), number)


def duration_ms(start: Column, end: Column) -> Column:
    """Milliseconds between two compact times; longer texts, such as request ids, are cut to 17 characters."""
    return compact_to_millis(end) - compact_to_millis(start)


def utc_millis(timestamp: Column) -> Column:
    """Milliseconds since the epoch of a timestamp without time zone, read as UTC whatever the session time zone is."""
    whole_days = F.unix_date(timestamp.cast("date")).cast("bigint") * 86_400_000
    clock = F.hour(timestamp).cast("bigint") * 3_600_000 + F.minute(timestamp).cast("bigint") * 60_000
    return whole_days + clock + F.floor(F.extract(F.lit("SECONDS"), timestamp) * 1000).cast("bigint")


def utc_timestamp(millis: Column) -> Column:
    """Timestamp without time zone, in UTC, of milliseconds since the epoch."""
    return F.timestamp_add("MILLISECOND", millis, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))

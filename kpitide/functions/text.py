"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def equals_ignore_case(left: Column, right: str) -> Column:
    return F.lower(left) == F.lit(right.lower())


def split_tokens(value: Column, delimiter: str = " ") -> Column:
    """Split on one character, keeping leading and inner empty tokens and dropping trailing ones.

    An empty text is one empty token; a text of delimiters alone has no token.
    """
    if len(delimiter) != 1:
        raise ValueError("the delimiter must be one character")
    trimmed = F.rtrim(value, F.lit(delimiter))
    return (
        F.when(value == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, re.escape(delimiter)))
    )


def record_line(consumer: str, topic: Column, offset: Column, message: Column) -> Column:
    """One display line per consumed record."""
    return F.concat(
        F.lit(f"Consumer: {consumer}, Topic: "),
        topic,
        F.lit(", Offset: "),
        offset.cast("string"),
        F.lit(", msg: "),
        message,
    )

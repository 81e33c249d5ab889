"""JVM hash codes as column expressions, for keys that must land where a JVM producer puts them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_RANGE = 1 << 32
_INT_MAX = (1 << 31) - 1


def _signed_int(unsigned: Column) -> Column:
    return F.when(unsigned > _INT_MAX, unsigned - _INT_RANGE).otherwise(unsigned)


def string_hash_code(text: Column) -> Column:
    """The 32-bit hash code of a string: a polynomial in 31 over its UTF-16 units."""

    def step(h: Column, char: Column) -> Column:
        point = F.ascii(char)
        # Characters beyond the first 65536 are two units.
        above = point - 0x10000
        first, second = F.shiftright(above, 10) + 0xD800, above.bitwiseAND(0x3FF) + 0xDC00
        mixed = F.when(point < 0x10000, h * 31 + point).otherwise((h * 31 + first) * 31 + second)
        return mixed.bitwiseAND(F.lit(_INT_RANGE - 1))

    chars = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))
    return _signed_int(F.aggregate(chars, F.lit(0).cast("bigint"), step))


def long_hash_code(number: Column) -> Column:
    """The 32-bit hash code of a long: its two halves folded together."""
    n = number.cast("bigint")
    return _signed_int(n.bitwiseXOR(F.shiftrightunsigned(n, 32)).bitwiseAND(F.lit(_INT_RANGE - 1)))


def partition_of(hash_code: Column, partitions: int) -> Column:
    """Absolute hash code modulo the number of partitions; the smallest int, which has no positive twin, counts as 0."""
    positive = F.when(hash_code == -_INT_MAX - 1, F.lit(0)).otherwise(F.abs(hash_code))
    return (positive % F.lit(partitions)).cast("int")

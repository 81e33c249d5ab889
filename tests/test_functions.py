from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kpitide.functions import arrays, hashing, text, times


def one(spark, column, value=None, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("compact", "expected"),
    [
        ("20240229235959999", datetime(2024, 2, 29, 23, 59, 59, 999000)),
        ("20240101000007179000000000000001", datetime(2024, 1, 1, 0, 0, 7, 179000)),
        ("20230229000000000", None),
        ("20241301000000000", None),
        ("20240101240000000", None),
        ("20240101006000000", None),
        ("20240101000060000", None),
        ("2024010100000717", None),
        (" 2024010100000717", None),
        ("-2024010100000717", None),
        ("2024010100000717 ", None),
        ("2024010100000.717", None),
        ("", None),
        (None, None),
    ],
)
def test_compact_times(spark, compact, expected):
    assert one(spark, times.compact_to_timestamp(F.col("x")), compact) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Shanghai"])
def test_durations_do_not_depend_on_the_session_zone(spark, zone):
    # 02:30 on that day does not exist in Los Angeles.
    start, end = "20240310013000000xyz", "20240310023000250"
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, times.duration_ms(F.col("x"), F.lit(end)), start) == 3_600_250
        assert one(spark, times.compact_to_millis(F.col("x")), "19700102000000001") == 86_400_001
        assert one(spark, times.compact_to_millis(F.col("x")), "19691231235959999") == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_keys(spark):
    keys = [times.day_key, times.hour_key, times.minute_key, times.day_hour_key, times.day_hour_minute_key]
    row = spark.createDataFrame([("20240102030405678",)], "x string").select(*[k(F.col("x")) for k in keys]).first()
    assert tuple(row) == ("20240102", "03", "04", "2024010203", "202401020304")


@pytest.mark.parametrize(
    ("value", "delimiter", "expected"),
    [
        ("", " ", [""]),
        (" ", " ", []),
        (",,", ",", []),
        (" a  b  ", " ", ["", "a", "", "b"]),
        ("a,b,,", ",", ["a", "b"]),
        ("a b", ",", ["a b"]),
        ("a.b", ".", ["a", "b"]),
        ("a|b|", "|", ["a", "b"]),
    ],
)
def test_split_tokens(spark, value, delimiter, expected):
    assert one(spark, text.split_tokens(F.col("x"), delimiter), value) == expected


def test_split_needs_one_character(spark):
    with pytest.raises(ValueError):
        text.split_tokens(F.col("x"), "ab")


@pytest.mark.parametrize("value", ["reChargeNotifyReq", "RECHARGENOTIFYREQ", "rechargenotifyreq"])
def test_equals_ignore_case(spark, value):
    assert one(spark, text.equals_ignore_case(F.col("x"), "reChargeNotifyReq"), value)
    assert not one(spark, text.equals_ignore_case(F.col("x"), "reChargeNotifyReq"), value + " ")


def test_arrays_cut_to_the_shorter(spark):
    df = spark.createDataFrame(
        [([1, 2, 3, 4, 12], [5, 6, 7, 8, 9]), ([7], [1, 2, 3, 4, 12]), ([], [1])], "a array<bigint>, b array<bigint>"
    )
    a, b = F.col("a"), F.col("b")
    rows = df.select(arrays.zip_short(a, b).alias("z"), arrays.add_short(a, b).alias("s")).collect()
    assert [[tuple(p) for p in r["z"]] for r in rows] == [[(1, 5), (2, 6), (3, 7), (4, 8), (12, 9)], [(7, 1)], []]
    assert [r["s"] for r in rows] == [[6, 8, 10, 12, 21], [8], []]


def _string_hash(value: str) -> int:
    h = 0
    data = value.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + data[i] * 256 + data[i + 1]) % 2**32
    return h - 2**32 if h >= 2**31 else h


@pytest.mark.parametrize("value", ["", "a", "abc", "purchase", "polygenelubricants", "北京", "a\U0001f600b", "x" * 300])
def test_string_hash(spark, value):
    assert one(spark, hashing.string_hash_code(F.col("x")), value) == _string_hash(value)


@pytest.mark.parametrize(("value", "code"), [(0, 0), (5, 5), (2**31, -(2**31)), (2**32, 1), (-1, 0), (-5, 4), (2**40 + 3, 259)])
def test_long_hash(spark, value, code):
    assert one(spark, hashing.long_hash_code(F.col("x")), value, "x bigint") == code


def test_partition_of_is_never_negative(spark):
    df = spark.createDataFrame([(-(2**31),), (-7,), (7,), (0,)], "x bigint")
    assert [r[0] for r in df.select(hashing.partition_of(F.col("x"), 4)).collect()] == [0, 3, 3, 0]

"""Parsing, rejects and KPIs on hand-made lines."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpitide.operators import keyed, kpi, parse, project
from kpitide.operators.lookup import with_province_name

GOOD = {
    "serviceName": "reChargeNotifyReq",
    "bussinessRst": "0000",
    "chargefee": "12.50",
    "provinceCode": "100",
    "requestId": "20240101101500000000000000000001",
    "receiveNotifyTime": "20240101101501250",
}


def line(**changes):
    fields = {k: v for k, v in {**GOOD, **changes}.items() if v is not ...}
    return json.dumps(fields)


def log(spark, *lines):
    return spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "seq bigint, value string")


REJECTS = [
    (None, "empty"),
    ("", "empty"),
    ("   ", "empty"),
    ("{", "bad_json"),
    ("null", "bad_json"),
    ("5", "bad_json"),
    ("no json", "bad_json"),
    (f"[{line()}]", "bad_json"),
    (line() + " tail", "bad_json"),
    (line()[:60], "bad_json"),
    ("{}", "missing_service_name"),
    (line(serviceName=...), "missing_service_name"),
    (line(bussinessRst=...), "missing_result"),
    (line(bussinessRst=None), "missing_result"),
    (line(provinceCode=...), "missing_province"),
    (line(requestId="2024010110150000"), "bad_request_id"),
    (line(requestId=...), "bad_request_id"),
    (line(requestId="x" * 20), "bad_request_id"),
    (line(requestId="20241301101500000"), "bad_start_time"),
    (line(receiveNotifyTime="soon"), "bad_receive_time"),
    (line(receiveNotifyTime=...), "bad_receive_time"),
    (line(chargefee="abc"), "bad_fee"),
    (line(chargefee="NaN"), "bad_fee"),
    (line(chargefee="abc", bussinessRst="0001"), "bad_fee"),
    (line(chargefee=...), "missing_fee"),
    (line(chargefee=""), "missing_fee"),
]
KEPT = [
    line(),
    line(serviceName="RECHARGENOTIFYREQ"),
    line(chargefee=12.5),
    line(chargefee=12),
    line(bussinessRst="0001"),
    line(bussinessRst="0001", chargefee=...),
    line(provinceCode="999"),
    f"  {line()}  ",
    line(more={"nested": [1, 2]}),
    line().replace("reCharge", "re\\u0043harge"),
]
OTHER = [line(serviceName="sendRechargeReq"), line(serviceName="sendRechargeReq", requestId="short")]


def test_rejects_have_their_reason_and_the_whole_line(spark):
    df = log(spark, *[v for v, _ in REJECTS], *KEPT, *OTHER)
    got = {r["seq"]: (r["value"], r["reason"]) for r in parse.rejected_records(df).collect()}
    assert got == dict(enumerate(REJECTS))


def test_every_line_is_kept_rejected_or_of_another_kind(spark):
    df = log(spark, *[v for v, _ in REJECTS], *KEPT, *OTHER)
    first = len(REJECTS)
    kept = {r["seq"] for r in parse.recharge_records(df).collect()}
    assert kept == set(range(first, first + len(KEPT)))


def test_base_row(spark):
    row = project.base_rows(log(spark, line()), "seq").first().asDict()
    assert row == {
        "seq": 0,
        "request_id": GOOD["requestId"],
        "province_code": "100",
        "result": "0000",
        "day": "20240101",
        "hour": "10",
        "minute": "15",
        "start_ts": datetime(2024, 1, 1, 10, 15),
        "end_ts": datetime(2024, 1, 1, 10, 15, 1, 250000),
        "orders": 1,
        "succ": 1,
        "fail": 0,
        "fee": Decimal("12.50"),
        "cost_ms": 1250,
    }


def test_failed_orders_count_without_fee_and_duration(spark):
    row = project.base_rows(log(spark, line(bussinessRst="0001"))).first()
    assert (row["orders"], row["succ"], row["fail"], row["fee"], row["cost_ms"]) == (1, 0, 1, Decimal("0.00"), 0)


def test_unknown_province_keeps_its_code(spark):
    rows = with_province_name(project.base_rows(log(spark, line(), line(provinceCode="999")))).collect()
    assert sorted(r["province"] for r in rows) == ["999", "北京"]


def test_own_dimension(spark):
    dim = spark.createDataFrame([("100", "capital")], "code string, name string")
    rows = with_province_name(project.base_rows(log(spark, line(), line(provinceCode="200"))), dim).collect()
    assert sorted(r["province"] for r in rows) == ["200", "capital"]


def test_ratios_without_success_are_null(spark):
    row = kpi.daily_ratios(project.base_rows(log(spark, line(bussinessRst="0001")))).first()
    assert row["success_rate"] == 0.0
    assert row["mean_cost_ms"] is None


def test_grains_agree_with_the_single_kpis(spark):
    lines = [line(provinceCode=p, chargefee=str(i), requestId=f"202401{d}{h}1500000") for i, (p, d, h) in enumerate(
        [("100", "01", "10"), ("100", "01", "11"), ("200", "01", "10"), ("200", "02", "10"), ("999", "02", "10")]
    )]
    rows = project.base_rows(log(spark, *lines))
    cells = kpi.all_grains(rows)
    for grain, single in [
        ("day", kpi.daily_overview), ("hour", kpi.hourly_money), ("minute", kpi.minute),
        ("day_province", kpi.province_failure), ("hour_province", kpi.hour_province),
    ]:
        from_cells = single(kpi.of_grain(cells, grain)).collect()
        assert sorted(map(tuple, from_cells)) == sorted(map(tuple, single(rows).collect())), grain
    assert cells.where(F.col("grain").isNull()).count() == 0


def test_batches_are_cut_before_adding(spark):
    lines = [line(chargefee="1.60"), line(chargefee="1.60"), line(chargefee="1.60")]
    rows = project.base_rows(log(spark, *lines), "seq").withColumn("batch_id", (F.col("seq") / 2).cast("bigint"))
    row = kpi.truncated_amounts(rows).first()
    assert (row["money_truncated"], row["money"]) == (3 + 1, 4.8)


def test_last_value_is_that_of_the_newest_batch(spark):
    df = spark.createDataFrame([("k", 1, 10), ("k", 3, 5), ("k", 2, 7), ("j", 1, 1)], "key string, batch_id bigint, n bigint")
    got = {r["key"]: r["n"] for r in keyed.last_value(df, ["key"], ["n"]).collect()}
    assert got == {"k": 5, "j": 1}


HOUR = 3600


@pytest.mark.parametrize(
    ("writes", "as_of", "expected"),
    [
        ([0, 1, 2], 2, 3),
        ([0, 1, 2], 25, 3),
        ([0, 1, 2], 26, None),
        ([0, 23, 46], 60, 3),
        ([0, 24], 24, 1),
        ([0, 30, 31], 40, 2),
        ([0, 30], 10, 1),
    ],
)
def test_expiry(spark, writes, as_of, expected):
    """Hours of writes to one key that lives 24 hours, and the sum it holds at an hour."""
    start = datetime(2024, 1, 1)
    rows = [("k", f"f{i % 2}", i, 1) for i in range(len(writes))]
    df = spark.createDataFrame(rows, "key string, field string, i int, n bigint")
    hours = F.element_at(F.array(*[F.lit(w) for w in writes]), F.col("i") + 1)
    df = df.withColumn("write_time", F.lit(start) + F.make_dt_interval(hours=hours))
    as_of_time = F.lit(start) + F.make_dt_interval(hours=F.lit(as_of))
    held = keyed.alive_at(df, ["key"], 24 * HOUR, as_of_time)
    assert held.agg(F.sum("n")).first()[0] == expected


def test_a_write_to_one_field_renews_the_whole_key(spark):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("k", "a", start, 1), ("k", "b", start.replace(hour=20), 2), ("k", "b", start.replace(day=2, hour=10), 4)],
        "key string, field string, write_time timestamp, n bigint",
    )
    held = keyed.alive_at(df, ["key"], 24 * HOUR, F.lit(datetime(2024, 1, 2, 12)))
    assert {r["field"] for r in held.collect()} == {"a", "b"}


def test_white_space_around_an_object_and_text_after_it(spark):
    whole = line()
    good = [whole, whole + "\n", whole + "\t", whole + "\r\n", "\n" + whole, "\t\r\n " + whole]
    bad = [f"{whole} {whole}", f"{whole}{whole}", f"{whole},{whole}", f"{whole} x", f'{whole},"x":{whole}', f"[{whole}]", "\x0b" + whole]
    df = spark.createDataFrame([(v,) for v in good + bad], "value string")
    assert parse.recharge_records(df).count() == len(good)
    assert sorted(r["value"] for r in parse.rejected_records(df).collect()) == sorted(bad)
    blank = spark.createDataFrame([(" \n",), ("\t",)], "value string")
    assert {r["reason"] for r in parse.rejected_records(blank).collect()} == {"empty"}


def test_variant_parse_equals_the_schema_parse(spark):
    lines = [
        GOOD_LINE := '{"serviceName":"reChargeNotifyReq","bussinessRst":"0000","chargefee":"1.50","provinceCode":"100","requestId":"1","receiveNotifyTime":"2"}',
        GOOD_LINE + " ",
        " \n\t" + GOOD_LINE + "\r\n",
        GOOD_LINE + GOOD_LINE,
        GOOD_LINE + "," + GOOD_LINE,
        GOOD_LINE[:30],
        '{"serviceName":null,"chargefee":12}',
        '{"serviceName":"a","other":{"serviceName":"b"}}',
        "{}",
        "[]",
        "1",
        "",
        "  ",
        None,
        '{"serviceName":"\\u0072x"}',
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "seq int, value string")
    one, two = (sorted(map(tuple, f(df).collect())) for f in (parse.parse_log, parse.parse_log_variant))
    assert [r[:-1] for r in one] == [r[:-1] for r in two]
    assert [r[0] for r in one if r[-1] is not None] == [r[0] for r in two if r[-1] is not None]

"""What the plans must look like to hold at scale."""

import json
import re

import pytest

from kpitide import app
from kpitide.operators import kpi
from kpitide.operators.project import base_rows
from kpitide.plans import QUERIES, streams
from kpitide.schemas import provinces
from kpitide.sources import tables
from kpitide.streaming import jobs
from kpitide.streaming.store import WholeResults
from tests.compare import DATA

SF_DIR = str(DATA / "sf0.001")
STREAMS = set(streams.QUERIES)
WRITTEN = {"running_word_count"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS - WRITTEN))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name].run(spark, SF_DIR))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, ENSURE", "ExistingRDD"):
        if bad == "SinglePartition, ENSURE" and name == "total_orders":
            continue
        assert bad not in text, bad


@pytest.mark.parametrize("name", ["kpi_daily_overview", "kpi_minute", "kpi_province_failure", "total_orders", "kpi_ttl_live"])
def test_the_log_is_parsed_once(spark, name):
    text = plan(QUERIES[name].run(spark, SF_DIR))
    assert text.count("from_json") == 1
    assert text.count("FileScan") == 1


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("parse_log", 0),
        ("base_projection", 0),
        ("rejected_records", 0),
        ("province_lookup", 0),
        ("tokenize", 0),
        ("partition_assign", 0),
        ("kpi_daily_overview", 1),
        ("kpi_hourly_money", 1),
        ("kpi_province_success", 1),
        ("kpi_grouping_sets", 2),
        ("top10_words", 1),
    ],
)
def test_shuffles(spark, name, shuffles):
    assert len(re.findall(r"Exchange hashpartitioning", plan(QUERIES[name].run(spark, SF_DIR)))) == shuffles


def test_orders_are_summed_before_the_grouping_sets(spark):
    rows = base_rows(tables.recharge_log(tables.table(spark, SF_DIR, "events")))
    text = plan(kpi.all_grains(rows))
    # The plan is printed from the result down: Expand stands above the first shuffle.
    assert text.index("Expand") < text.rindex("Exchange hashpartitioning")


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["offset_ranges"].run(spark, SF_DIR))
    assert "props" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["earliest_offsets"].run(spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", text)


def test_the_province_table_is_broadcast_as_it_has_31_rows(spark):
    assert provinces(spark).count() == 31
    assert "BroadcastHashJoin" in plan(QUERIES["province_lookup"].run(spark, SF_DIR))


def test_command_line(spark, tmp_path):
    lines = tmp_path / "in"
    lines.mkdir()
    (lines / "a.txt").write_text("a,b\n")
    for job in ("kpi", "daily", "words", "seeded-words", "consume"):
        app.main([job, "--files", str(lines), "--out", str(tmp_path / job)], spark)
    counts = WholeResults(spark, str(tmp_path / "words" / "counts"), 1).newest()
    assert {(r["word"], r["n"]) for r in counts.collect()} == {("a", 1), ("b", 1)}
    rejects = spark.read.parquet(str(tmp_path / "kpi" / "rejects"))
    assert [r["reason"] for r in rejects.collect()] == ["bad_json"]
    with pytest.raises(SystemExit):
        app.main(["kpi", "--out", str(tmp_path / "x")], spark)


def test_command_line_resumes_from_a_ledger(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    listener = jobs.LedgerListener(spark, ledger, "g", jobs.KPI_QUERY)
    listener.store(['{"t":{"0":5,"1":3}}'], 0)
    listener.store(['{"t":{"0":9}}'], 1)
    args = ["kpi", "--servers", "h:1", "--topics", "t", "--out", str(tmp_path), "--group", "g"]
    plain = app.parser().parse_args(args)
    assert app.first_offsets(spark, plain) == "earliest"
    resumed = app.parser().parse_args([*args, "--resume-from", ledger, "--partition-counts", '{"t": 3}'])
    assert json.loads(app.first_offsets(spark, resumed)) == {"t": {"0": 9, "1": 3, "2": -2}}

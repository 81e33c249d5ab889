"""The jobs as started from the command line, over files."""

import pytest

from kpitide import app
from kpitide.operators import kpi
from kpitide.streaming import event_time, jobs, top
from kpitide.streaming.store import WholeResults
from tests.test_streaming import Folder, record


@pytest.fixture
def started(spark, tmp_path):
    folder = Folder(tmp_path / "in")
    folder.put(record(1), record(2), "{bad")
    folder.put(record(1, ok=False), "a b,a")
    out = str(tmp_path / "out")

    def run(job, *more):
        app.main([job, "--files", str(tmp_path / "in"), "--files-per-batch", "1", "--out", out, *more], spark)
        return out

    return run


def test_kpi_and_rejects_from_one_read(spark, started):
    out = started("kpi")
    assert kpi.of_grain(jobs.kpi_sums(spark, f"{out}/cells").totals(), "day").first()["orders"] == 3
    assert sorted(r["value"] for r in spark.read.parquet(f"{out}/rejects").collect()) == ["a b,a", "{bad"]


def test_stored_sums(spark, started):
    out = started("daily")
    assert [r["value"] for r in jobs.counter_sums(spark, f"{out}/counters").totals().collect()] == [2]
    assert started("windows", "--width", "1 hour") == out


def test_windows_that_close_and_top_words_by_sketch(spark, started):
    out = started("windows", "--width", "1 minute", "--delay", "0 minutes")
    store = event_time.window_store(spark, f"{out}/windows")
    assert sum(r["orders"] for r in event_time.all_windows(store, f"{out}/checkpoint").collect()) == 3
    assert app.seconds_of("2 minutes") == 120


def test_top_words_by_sketch(spark, started):
    out = started("top-words", "--tracked", "64")
    assert top.top_words(top.top_store(spark, f"{out}/counts", 64), 1).count() == 1


def test_last_values(spark, started):
    out = started("last")
    assert {r["key"]: r["orders"] for r in jobs.last_kpis(jobs.last_kpi_rows(spark, f"{out}/last")).collect()}["totalA-20240101"] == 1


@pytest.mark.parametrize("job", ["words", "top-words", "seeded-words", "running-words", "consume"])
def test_other_jobs_run(spark, started, job):
    out = started(job)
    if job in ("words", "top-words"):
        assert WholeResults(spark, f"{out}/counts", 1).newest().count() > 0
    elif job == "seeded-words":
        assert jobs.seeded_counts(jobs.seeded_rows(spark, f"{out}/counts")).count() > 0
    elif job == "running-words":
        assert spark.read.parquet(f"{out}/counts").count() > 0


def test_offsets_are_clamped_to_what_is_held(spark, tmp_path):
    jobs.LedgerListener(spark, str(tmp_path / "l"), "kpitide", "kpi").store(['{"t":{"0":5,"1":3}}'], 1)
    args = app.parser().parse_args(
        ["kpi", "--out", "x", "--resume-from", str(tmp_path / "l"), "--earliest", '{"t":{"0":7,"1":1,"2":4}}']
    )
    assert app.first_offsets(spark, args) == '{"t": {"0": 7, "1": 3, "2": 4}}'

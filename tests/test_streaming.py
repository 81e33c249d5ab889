import json
import os
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kpitide.operators import kpi
from kpitide.operators.project import base_rows
from kpitide.sources.files import stream_lines
from kpitide.streaming import jobs
from kpitide.streaming.store import WholeResults

GOOD = {
    "serviceName": "reChargeNotifyReq",
    "bussinessRst": "0000",
    "chargefee": "1.25",
    "provinceCode": "100",
    "receiveNotifyTime": "20240101101501250",
}


def record(minute: int, day: int = 1, ok: bool = True, province: str = "100") -> str:
    at = datetime(2024, 1, day, 10) + timedelta(minutes=minute)
    fields = {
        **GOOD,
        "bussinessRst": "0000" if ok else "0001",
        "provinceCode": province,
        "requestId": at.strftime("%Y%m%d%H%M%S000") + "7",
        "receiveNotifyTime": at.strftime("%Y%m%d%H%M%S250"),
    }
    return json.dumps(fields)


class Folder:
    """A folder of text files that a stream reads one by one, in the order they are put."""

    def __init__(self, path):
        self.path = path
        path.mkdir()
        self.clock = time.time() - 1000

    def put(self, *lines: str) -> None:
        self.clock += 1
        name = self.path / f"{int(self.clock * 1000)}.txt"
        name.write_text("\n".join(lines) + "\n")
        os.utime(name, (self.clock, self.clock))

    def stream(self, spark):
        return stream_lines(spark, str(self.path), files_per_batch=1)


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path / "in")


def sample_lines(n=120):
    rng = random.Random(3)
    return [
        record(rng.randrange(300), rng.choice([1, 1, 1, 2]), rng.random() < 0.8, rng.choice(["100", "200", "999"]))
        for _ in range(n)
    ] + ["{bad", "", record(0)[:50]]


def as_set(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_batch_in_any_order_of_files(spark, folder, tmp_path, seed):
    lines = sample_lines()
    random.Random(seed).shuffle(lines)
    for i in range(0, len(lines), 40):
        folder.put(*lines[i : i + 40])
    sums = jobs.kpi_sums(spark, str(tmp_path / "cells"))
    jobs.run(jobs.kpi_stream(folder.stream(spark), sums, str(tmp_path / "cp"), compact_every=2))
    log = spark.createDataFrame([(v,) for v in lines], "value string")
    expected = kpi.all_grains(base_rows(log))
    assert as_set(sums.totals().select(*expected.columns)) == as_set(expected)
    assert sums.batches().select("batch_id").distinct().count() == 4


def test_restart_goes_on_and_late_orders_add_to_their_day(spark, folder, tmp_path):
    sums = jobs.kpi_sums(spark, str(tmp_path / "cells"))

    def orders():
        jobs.run(jobs.kpi_stream(folder.stream(spark), sums, str(tmp_path / "cp")))
        days = kpi.of_grain(sums.totals(), "day").select("day", "orders").collect()
        return {r["day"]: r["orders"] for r in days}

    folder.put(record(1, day=1), record(2, day=1))
    folder.put(record(1, day=20))
    assert orders() == {"20240101": 2, "20240120": 1}
    folder.put(record(3, day=1))
    assert orders() == {"20240101": 3, "20240120": 1}
    assert orders() == {"20240101": 3, "20240120": 1}


def put_words(spark, sums, batch_id, when=None, **counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    sums.put(df, batch_id, None if when is None else F.lit(when))


def held(df):
    return {r["word"]: r["n"] for r in df.collect()}


def test_a_repeated_batch_is_not_counted_twice(spark, tmp_path):
    sums = jobs.word_sums(spark, str(tmp_path / "w"))
    assert held(sums.totals()) == {}
    put_words(spark, sums, 0, a=1, b=2)
    put_words(spark, sums, 1, a=10)
    put_words(spark, sums, 1, a=10)
    assert held(sums.totals()) == {"a": 11, "b": 2}
    assert held(sums.totals(before=1)) == {"a": 1, "b": 2}
    assert held(jobs.word_sums(spark, str(tmp_path / "w")).totals()) == {"a": 11, "b": 2}


def test_compaction_changes_nothing_but_where_sums_are_kept(spark, tmp_path):
    sums = jobs.word_sums(spark, str(tmp_path / "w"))
    for batch in range(5):
        put_words(spark, sums, batch, a=batch + 1, **{f"w{batch}": 1})
    before = held(sums.totals())
    sums.compact(2)
    sums.compact(2)
    assert held(sums.totals()) == before
    put_words(spark, sums, 4, a=50)
    assert held(sums.totals())["a"] == 1 + 2 + 3 + 4 + 50
    sums.compact(3)
    assert held(sums.totals())["a"] == 60
    with pytest.raises(ValueError):
        sums.totals(before=2)


def test_a_compaction_cut_short_is_not_read(spark, tmp_path):
    sums = jobs.word_sums(spark, str(tmp_path / "w"))
    put_words(spark, sums, 0, a=1)
    put_words(spark, sums, 1, a=2)
    # A base without its entry among the finished ones.
    junk = spark.createDataFrame([("a", 99, None)], sums.schema)
    junk.write.parquet(str(tmp_path / "w" / "base" / "run=0" / "upto=0"))
    assert held(sums.totals()) == {"a": 3}
    sums.compact(0)
    assert held(sums.totals()) == {"a": 3}


@pytest.mark.parametrize("compact_at", [None, 0, 1, 2])
def test_expiry_with_and_without_compaction(spark, tmp_path, compact_at):
    start = datetime(2024, 1, 1)
    sums = jobs.word_sums(spark, str(tmp_path / "w"), ttl=3600)
    put_words(spark, sums, 0, start, a=1, b=1)
    put_words(spark, sums, 1, start + timedelta(minutes=50), a=2)
    put_words(spark, sums, 2, start + timedelta(minutes=100), a=4, b=8)
    if compact_at is not None:
        sums.compact(compact_at)
    put_words(spark, sums, 3, start + timedelta(minutes=150), a=16)
    # b was gone when it was written again.
    assert held(sums.totals()) == {"a": 23, "b": 8}
    assert held(sums.live(F.lit(start + timedelta(minutes=155)))) == {"a": 23, "b": 8}
    assert held(sums.live(F.lit(start + timedelta(minutes=165)))) == {"a": 23}
    assert held(sums.live(F.lit(start + timedelta(minutes=210)))) == {}


def batches(stored):
    found = {}
    for row in stored.collect():
        found.setdefault(row["batch_id"], {})[row["word"]] = row["n"]
    return found


def test_cumulative_count_shows_all_words_after_each_batch(spark, folder, tmp_path):
    folder.put("a,b,,", "", ",,")
    folder.put("b,c")
    out = str(tmp_path / "out")
    jobs.run(jobs.cumulative_word_stream(folder.stream(spark), out, str(tmp_path / "cp")))
    results = WholeResults(spark, out, jobs.KEEP_BATCHES)
    assert batches(results.all()) == {0: {"a": 1, "b": 1, "": 1}, 1: {"a": 1, "b": 2, "": 1, "c": 1}}
    folder.put("c")
    jobs.run(jobs.cumulative_word_stream(folder.stream(spark), out, str(tmp_path / "cp")))
    assert batches(results.all())[2] == {"a": 1, "b": 2, "": 1, "c": 2}


@pytest.mark.parametrize("top", [False, True])
def test_a_new_checkpoint_gives_new_whole_results(spark, folder, tmp_path, top):
    job = jobs.top_word_stream if top else jobs.cumulative_word_stream
    out = str(tmp_path / "out")
    for _ in range(4):
        folder.put("a b")
    jobs.run(job(folder.stream(spark), out, str(tmp_path / "cp1"), delimiter=" "))
    results = WholeResults(spark, out, jobs.KEEP_BATCHES)
    assert held(results.newest()) == {"a": 4, "b": 4}
    folder.put("a c")
    whole = stream_lines(spark, str(folder.path))  # all files in one batch: lower ids than those of the run before
    jobs.run(job(whole, out, str(tmp_path / "cp2"), delimiter=" "))
    assert held(results.newest()) == {"a": 5, "b": 4, "c": 1}
    for _ in range(6):
        folder.put("c")
        jobs.run(job(stream_lines(spark, str(folder.path)), out, str(tmp_path / "cp2"), delimiter=" "))
    assert held(results.newest()) == {"a": 5, "b": 4, "c": 7}
    assert len(results.versions()) == jobs.KEEP_BATCHES


def test_a_whole_result_cut_short_is_not_read(spark, tmp_path):
    results = WholeResults(spark, str(tmp_path / "out"), 3)
    for n in range(2):
        results.put(spark.createDataFrame([("a", n)], "word string, n int"), n)
    (tmp_path / "out" / "results" / "run=0" / "batch_id=1" / "_SUCCESS").unlink()
    assert held(results.newest()) == {"a": 0}


def test_seeded_count_shows_the_words_of_each_batch(spark, folder, tmp_path):
    folder.put("hello x")
    folder.put("x x")
    seed = spark.createDataFrame([("hello", 1), ("world", 1)], "word string, n0 bigint")
    latest = jobs.seeded_rows(spark, str(tmp_path / "out"))
    jobs.run(jobs.seeded_word_stream(folder.stream(spark), seed, latest, str(tmp_path / "cp")))
    assert batches(latest.batches()) == {0: {"hello": 2, "x": 1}, 1: {"x": 3}}
    assert held(jobs.seeded_counts(latest)) == {"hello": 2, "x": 3}


def test_seeded_counts_start_again_without_their_checkpoint_and_keep_few_folders(spark, folder, tmp_path):
    folder.put("hello x y")
    for _ in range(9):
        folder.put("x")
    seed = spark.createDataFrame([("hello", 1)], "word string, n0 bigint")
    latest = jobs.seeded_rows(spark, str(tmp_path / "out"))
    jobs.run(jobs.seeded_word_stream(folder.stream(spark), seed, latest, str(tmp_path / "cp1"), compact_every=2))
    assert held(jobs.seeded_counts(latest)) == {"hello": 2, "x": 10, "y": 1}
    assert len(list((tmp_path / "out" / "batches" / "run=0").iterdir())) <= 6
    later = Folder(tmp_path / "later")
    later.put("x", "z")
    jobs.run(jobs.seeded_word_stream(later.stream(spark), seed, latest, str(tmp_path / "cp2"), compact_every=2))
    assert held(jobs.seeded_counts(latest)) == {"x": 1, "z": 1}


def test_top_words_of_the_stream(spark, folder, tmp_path):
    folder.put("a b b")
    folder.put("c c c a")
    out = str(tmp_path / "out")
    jobs.run(jobs.top_word_stream(folder.stream(spark), out, str(tmp_path / "cp"), k=2))
    assert batches(WholeResults(spark, out, 3).all()) == {0: {"b": 2, "a": 1}, 1: {"c": 3, "a": 2}}


def test_running_count_goes_on_over_batches_and_restarts(spark, folder, tmp_path):
    seed = spark.createDataFrame([("hello", 1)], "word string, n0 bigint")
    totals = jobs.word_sums(spark, str(tmp_path / "totals"))
    out = str(tmp_path / "out")

    def run():
        lines = folder.stream(spark).withColumn("seq", F.substring_index("value", ":", 1).cast("int"))
        lines = lines.withColumn("value", F.substring_index("value", ":", -1))
        jobs.run(jobs.running_word_stream(lines, ["seq"], totals, out, str(tmp_path / "cp"), seed))
        rows = spark.read.parquet(out).orderBy("batch_id", "seq", "pos").collect()
        return [(r["word"], r["n"]) for r in rows]

    folder.put("1:hello a", "2:a a")
    folder.put("1:a hello")
    first = [("hello", 2), ("a", 1), ("a", 2), ("a", 3), ("a", 4), ("hello", 3)]
    assert run() == first
    folder.put("1:b a")
    assert run() == first + [("b", 1), ("a", 5)]


@pytest.mark.parametrize("files", [1, 20])
def test_windows_lose_no_late_order(spark, folder, tmp_path, files):
    lines = [record(m) for m in [0, 0, 1, 30, 31, 0, 29, 60, 90, 2, 5, 61, 0, 1, 45, 46, 47, 48, 200, 3]]
    for i in range(files):
        folder.put(*lines[i::files])
    sums = jobs.window_sums(spark, str(tmp_path / "windows"))
    jobs.run(jobs.window_stream(folder.stream(spark), sums, str(tmp_path / "cp"), compact_every=7))
    log = spark.createDataFrame([(v,) for v in lines], "value string")
    whole = kpi.window_sums(base_rows(log), "1 minute")
    assert as_set(sums.totals().select(*whole.columns)) == as_set(whole)


def test_windows_do_not_follow_the_session_zone(spark, folder, tmp_path):
    folder.put(record(0))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        sums = jobs.window_sums(spark, str(tmp_path / "windows"))
        jobs.run(jobs.window_stream(folder.stream(spark), sums, str(tmp_path / "cp"), width="1 day"))
        assert sums.totals().first()["window_start"] == datetime(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_new_run_adds_to_what_the_old_one_stored(spark, tmp_path):
    path = str(tmp_path / "w")
    sums = jobs.word_sums(spark, path).begin(str(tmp_path / "cp1"))
    for batch in range(4):
        put_words(spark, sums, batch, a=1)
    again = jobs.word_sums(spark, path).begin(str(tmp_path / "cp2"))
    put_words(spark, again, 0, a=1)
    put_words(spark, again, 1, a=1)
    assert held(again.totals()) == {"a": 6} and held(again.totals(before=1)) == {"a": 5}
    again.compact(0)
    put_words(spark, again, 2, a=1)
    assert held(again.totals()) == {"a": 7}
    same = jobs.word_sums(spark, path).begin(str(tmp_path / "cp2"))
    assert same.run == again.run
    put_words(spark, same, 2, a=1)
    assert held(same.totals()) == {"a": 7}
    with pytest.raises(ValueError):
        jobs.word_sums(spark, path).begin(str(tmp_path / "cp1"))


def test_orders_count_once_over_a_restart_without_checkpoint(spark, folder, tmp_path):
    sums = jobs.kpi_sums(spark, str(tmp_path / "cells"))
    for i in range(3):
        folder.put(record(i))
    jobs.run(jobs.kpi_stream(folder.stream(spark), sums, str(tmp_path / "cp"), compact_every=2))
    later = Folder(tmp_path / "later")  # what comes after the stored offsets
    for i in range(3):
        later.put(record(10 + i))
    sums = jobs.kpi_sums(spark, str(tmp_path / "cells"))
    jobs.run(jobs.kpi_stream(later.stream(spark), sums, str(tmp_path / "cp-new"), compact_every=2))
    assert kpi.of_grain(sums.totals(), "day").first()["orders"] == 6


@pytest.mark.parametrize("ttl", [None, 3600])
def test_folders_stay_few(spark, tmp_path, ttl):
    sums = jobs.word_sums(spark, str(tmp_path / "w"), ttl=ttl).begin(str(tmp_path / "cp"))
    for batch in range(24):
        put_words(spark, sums, batch, datetime(2024, 1, 1, 0, batch), a=1)
        if batch and batch % 4 == 0:
            sums.compact(batch - 1)
            assert len(list((tmp_path / "w" / "batches" / f"run={sums.run}").iterdir())) <= 10
    assert held(sums.totals()) == {"a": 24}
    assert len(list((tmp_path / "w" / "compacted").iterdir())) <= 2


def test_overwritten_kpis_and_counters(spark, folder, tmp_path):
    for lines in ([record(1), record(2)], [record(1)], [record(70)], [record(1, day=2)]):
        folder.put(*lines)
    latest = jobs.last_kpi_rows(spark, str(tmp_path / "last"))
    assert jobs.last_kpis(latest).collect() == []
    jobs.run(jobs.overwrite_stream(folder.stream(spark), latest, str(tmp_path / "cp"), compact_every=2))
    last = {r["key"]: (r["orders"], r["batch_id"]) for r in jobs.last_kpis(latest).collect()}
    assert last["totalA-20240101"] == (1, 2) and last["totalA-20240102"] == (1, 3)
    assert last["succ_everyminC-202401011001"] == (1, 1) and last["succ_everyminC-202401011002"] == (1, 0)
    counters = jobs.counter_sums(spark, str(tmp_path / "counters"))
    jobs.run(jobs.counter_stream(folder.stream(spark), counters, "S-", str(tmp_path / "cp2"), compact_every=2))
    assert {r["key"]: r["value"] for r in counters.totals().collect()} == {"S-20240101": 4, "S-20240102": 1}


def minute_keys(latest):
    return {r["key"][-4:]: (r["orders"], r["in_run"], r["in_batch"]) for r in latest.rows().collect()}


def put_minutes(spark, latest, batch, **orders):
    rows = [(f"k{key[1:]:>03}", n, 0, 0.0, 0) for key, n in orders.items()]
    latest.put(spark.createDataFrame(rows, jobs.LAST_KPIS), batch, F.lit(datetime(2024, 1, 1, batch)))


def test_overwritten_values_outlive_all_folds(spark, folder, tmp_path):
    for minute in range(8):
        folder.put(record(minute), record(minute), record(0))
    latest = jobs.last_kpi_rows(spark, str(tmp_path / "last"))
    jobs.run(jobs.overwrite_stream(folder.stream(spark), latest, str(tmp_path / "cp"), compact_every=2))
    last = {r["key"]: (r["orders"], r["batch_id"]) for r in jobs.last_kpis(latest).collect()}
    minutes = {f"succ_everyminC-20240101100{m}": (2, m) for m in range(1, 8)} | {"succ_everyminC-202401011000": (1, 7)}
    assert {k: v for k, v in last.items() if k.startswith("succ")} == minutes


@pytest.mark.parametrize("crash", ["base", "entry", "clear", "drop", None])
def test_twenty_batches_with_crashes_lose_no_key(spark, tmp_path, monkeypatch, crash):
    """Each step of each compaction fails once, and the batch is run again, as Spark would."""
    latest = jobs.last_kpi_rows(spark, str(tmp_path / "last")).begin(str(tmp_path / "cp"))
    failing = [False]

    def once(owner, name, before=True):
        real = getattr(owner, name)

        def call(*args):
            if failing[0]:
                failing[0] = False
                if not before:
                    real(*args)
                raise OSError("lost")
            return real(*args)

        monkeypatch.setattr(owner, name, call)

    if crash == "base":
        once(latest, "_write_base")
    elif crash == "entry":  # the base is there, the entry that makes it count is not
        real = latest._write_base

        def torn(rows, run, upto):
            real(rows, run, upto)
            if failing[0]:
                failing[0] = False
                latest.folders.drop(f"compacted/{run}.{upto}/_SUCCESS")
                raise OSError("lost")

        monkeypatch.setattr(latest, "_write_base", torn)
    elif crash == "clear":
        once(latest, "_clear")
    elif crash == "drop":  # after the first folder is deleted
        once(latest.folders, "drop", before=False)
    expected = {}
    for batch in range(20):
        for attempt in range(2):
            put_minutes(spark, latest, batch, **{f"m{batch}": batch + 1, "m99": batch})
            failing[0] = crash is not None and attempt == 0
            try:
                latest.after_batch(batch, 2)
                break
            except OSError:
                pass
            finally:
                failing[0] = False
        expected |= {f"k{batch:>03}": (batch + 1, 0, batch), "k099": (batch, 0, batch)}
        if batch % 5 == 4:
            assert minute_keys(latest) == expected
    assert len(list((tmp_path / "last" / "batches" / "run=0").iterdir())) <= 6


def test_a_new_run_overwrites_and_keys_expire(spark, tmp_path):
    path = str(tmp_path / "last")
    old = jobs.last_kpi_rows(spark, path).begin(str(tmp_path / "cp1"))
    for batch in range(4):
        put_minutes(spark, old, batch, m1=batch, **{f"m{10 + batch}": 1})
    new = jobs.last_kpi_rows(spark, path, ttl=2 * 3600).begin(str(tmp_path / "cp2"))
    put_minutes(spark, new, 0, m1=50)
    assert minute_keys(new)["k001"] == (50, 1, 0) and len(minute_keys(new)) == 5
    put_minutes(spark, new, 1, m2=1)
    new.compact(0)
    assert minute_keys(new)["k001"] == (50, 1, 0) and len(minute_keys(new)) == 6
    live = {r["key"] for r in new.live(F.lit(datetime(2024, 1, 1, 2, 30))).collect()}
    assert live == {"k002", "k011", "k012", "k013"} - {"k011"}


def test_a_failed_query_is_reported(spark, folder, tmp_path):
    folder.put("a")

    def fail(batch, batch_id):
        raise ValueError("no disk")

    slow = jobs.console_stream(folder.stream(spark), str(tmp_path / "cp1"), every="1 seconds")
    bad = jobs.start(folder.stream(spark).writeStream.foreachBatch(fail), str(tmp_path / "cp2"), "1 seconds")
    with pytest.raises(Exception, match="no disk"):
        jobs.watch([slow, bad])
    assert not slow.isActive


def test_rejects_are_stored_and_the_rest_goes_on(spark, folder, tmp_path):
    folder.put(record(1), "{bad")
    folder.put("x")
    jobs.run(jobs.reject_stream(folder.stream(spark), str(tmp_path / "out"), str(tmp_path / "cp")))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["value"], r["reason"]) for r in got) == [("x", "bad_json"), ("{bad", "bad_json")]


def test_daily_totals_are_of_each_batch_alone(spark, folder, tmp_path):
    folder.put(record(1), record(2))
    folder.put(record(3))
    shown = []
    job = jobs.daily_totals_stream(
        folder.stream(spark), lambda df, i: shown.extend((i, *r) for r in df.drop("batch_id").collect()), str(tmp_path / "cp")
    )
    jobs.run(job)
    assert shown == [(0, "20240101", 2, 2.5, 500), (1, "20240101", 1, 1.25, 250)]


def test_console(spark, folder, tmp_path):
    folder.put("a")
    jobs.run(jobs.console_stream(folder.stream(spark), str(tmp_path / "cp")))


def test_stopping_between_batches_loses_nothing(spark, folder, tmp_path):
    sums = jobs.kpi_sums(spark, str(tmp_path / "cells"))
    folder.put(record(1))
    query = jobs.kpi_stream(folder.stream(spark), sums, str(tmp_path / "cp"), every="1 seconds")
    query.processAllAvailable()
    query.stop()
    folder.put(record(2))
    jobs.run(jobs.kpi_stream(folder.stream(spark), sums, str(tmp_path / "cp")))
    assert kpi.of_grain(sums.totals(), "day").first()["orders"] == 2


def test_ledger_of_a_query(spark, tmp_path):
    path = str(tmp_path / "ledger")
    listener = jobs.LedgerListener(spark, path, "g", "kpi")
    listener.store(['{"t":{"0":5,"1":3}}'], 1)
    listener.store(['{"t":{"0":9}}'], 2)
    listener.store(['{"t":{"0":9}}'], 2)

    def stored():
        return {(r["topic"], r["groupid"], r["partitions"]): r["offset"] for r in jobs.stored_ledger(spark, path).collect()}

    assert stored() == {("t", "g", 0): 9, ("t", "g", 1): 3}
    jobs.LedgerListener(spark, path, "g", "kpi", run=1).store(['{"t":{"0":20}}'], 0)
    assert stored()[("t", "g", 0)] == 20


def test_one_connection_per_partition(spark, tmp_path):
    folder = str(tmp_path)

    def connect():
        import uuid

        return open(f"{folder}/{uuid.uuid4().hex}.part", "w")

    def put(connection, row):
        connection.write(f"{row['id']}\n")

    jobs.put_partitions(spark.range(0, 10, 1, 3), connect, put)
    parts = list(tmp_path.glob("*.part"))
    assert len(parts) == 3
    assert sorted(int(v) for p in parts for v in p.read_text().split()) == list(range(10))

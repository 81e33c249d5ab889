"""Jobs that keep state in Spark, and the sink that writes to an outside store once."""

import json
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpitide.operators import kpi
from kpitide.operators.parse import rejected_records
from kpitide.operators.project import base_rows
from kpitide.streaming import event_time, jobs, keyed_state, once, top
from tests.test_streaming import Folder, as_set, folder, held, record, sample_lines  # noqa: F401

MINUTES = [0, 0, 1, 30, 31, 0, 29, 60, 90, 2, 5, 61, 0, 1, 45, 46, 47, 48, 200, 3]


def plain_late(batches, delay):
    """Late orders by minute, and the minutes that have closed, as the watermark (in minutes) goes on after each batch."""
    mark, late, come = float("-inf"), {}, set()
    for minutes in batches:
        for m in minutes:
            if m + 1 <= mark:
                late[m] = late.get(m, 0) + 1
            else:
                come.add(m)
        mark = max(mark, max(minutes) - delay)
    return late, {m for m in come if m + 1 <= mark}


@pytest.mark.parametrize("files", [1, 20])
def test_closed_late_and_open_windows_are_all_orders(spark, folder, tmp_path, files):  # noqa: F811
    batches = [MINUTES[i::files] for i in range(files)]
    for minutes in batches:
        folder.put(*map(record, minutes))
    store, checkpoint = event_time.window_store(spark, str(tmp_path / "windows")), str(tmp_path / "cp")
    jobs.run(event_time.closing_window_stream(folder.stream(spark), store, checkpoint, delay="10 minutes", compact_every=7))
    log = spark.createDataFrame([(record(m),) for m in MINUTES], "value string")
    whole = kpi.window_sums(base_rows(log), "1 minute")
    assert as_set(event_time.all_windows(store, checkpoint).select(*whole.columns)) == as_set(whole)
    late, closed = plain_late(batches, 10)
    start = datetime(2024, 1, 1, 10)
    assert {int((r["window_start"] - start).seconds / 60): r["orders"] for r in event_time.late_orders(store).collect()} == late
    assert {int((r["window_start"] - start).seconds / 60) for r in event_time.closed_windows(store).collect()} == closed
    assert (files == 1) != bool(late)


def test_closing_windows_go_on_after_a_restart(spark, folder, tmp_path):  # noqa: F811
    store, checkpoint = event_time.window_store(spark, str(tmp_path / "windows")), str(tmp_path / "cp")

    def run(*minutes):
        folder.put(*map(record, minutes))
        jobs.run(event_time.closing_window_stream(folder.stream(spark), store, checkpoint, delay="0 minutes"))
        rows = [sorted((r["window_start"].minute, r["orders"]) for r in f.collect()) for f in (event_time.closed_windows(store), event_time.late_orders(store))]
        return [*rows, sorted((r["window_start"].minute, r["orders"]) for r in event_time.open_windows(spark, checkpoint).collect())]

    assert run(0, 0, 5) == [[(0, 2)], [], [(5, 1)]]
    assert run(0, 5) == [[(0, 2)], [(0, 1)], [(5, 2)]]
    assert run(7, 0) == [[(0, 2), (5, 2)], [(0, 2)], [(7, 1)]]


def test_running_count_through_state(spark, folder, tmp_path):  # noqa: F811
    seed = spark.createDataFrame([("hello", 1), ("world", 1)], "word string, n0 bigint")
    keys = T.StructType([T.StructField("seq", T.IntegerType())])
    numbered, out = str(tmp_path / "numbered"), str(tmp_path / "out")

    def run():
        lines = folder.stream(spark).withColumn("seq", F.substring_index("value", ":", 1).cast("int"))
        lines = lines.withColumn("value", F.substring_index("value", ":", -1))
        jobs.run(keyed_state.numbered_stream(lines, ["seq"], numbered, str(tmp_path / "cp1")))
        jobs.run(keyed_state.running_state_stream(numbered, keys, spark, out, str(tmp_path / "cp2"), seed))
        rows = spark.read.parquet(f"{out}/counts").orderBy("seq", "pos").collect()
        return [(r["word"], r["n"]) for r in rows]

    folder.put("2:a a", "1:hello a")
    folder.put(*[f"{i}:hot x{i} hot" for i in range(3, 40)])
    first = run()
    assert first[:4] == [("hello", 2), ("a", 1), ("a", 2), ("a", 3)]
    assert [n for w, n in first if w == "hot"] == list(range(1, 75))
    folder.put("50:hot hello b")
    assert run() == [*first, ("hot", 75), ("hello", 3), ("b", 1)]
    assert run() == [*first, ("hot", 75), ("hello", 3), ("b", 1)]


def test_the_seed_counts_once_over_restarts(spark, folder, tmp_path):  # noqa: F811
    seed = spark.createDataFrame([("hello", 1), ("world", 1)], "word string, n0 bigint")
    latest = jobs.seeded_rows(spark, str(tmp_path / "out"))
    for line, expected in (("hello x", {"hello": 2, "x": 1}), ("x hello world", {"hello": 3, "x": 2, "world": 2})):
        folder.put(line)
        jobs.run(keyed_state.seeded_state_stream(folder.stream(spark), seed, latest, str(tmp_path / "cp"), compact_every=1))
        assert held(jobs.seeded_counts(latest)) == expected


def test_sums_in_state_expire(spark, tmp_path):
    at = str(tmp_path / "in")
    schema = "day string, orders bigint, succ bigint, fee decimal(18,2), cost_ms bigint, write_time timestamp_ntz"
    latest = keyed_state.expiring_rows(spark, str(tmp_path / "out"))

    def run(*writes):
        rows = [(day, 1, 1, None, 5, datetime(2024, 1, 1, 0, minute)) for day, minute in writes]
        df = spark.createDataFrame(rows, schema).fillna({}).withColumn("fee", F.lit("1.50").cast("decimal(18,2)"))
        df.coalesce(1).write.mode("append").parquet(at)
        jobs.run(keyed_state.expiring_stream(spark.readStream.schema(df.schema).parquet(at), 1200, latest, str(tmp_path / "cp")))
        found = keyed_state.held_totals(latest, 1200).collect()
        return {r["day"]: (r["segment_start"].minute, r["expires_at"].minute, r["orders"], r["money"]) for r in found}

    assert run(("a", 0), ("a", 10), ("b", 0)) == {"a": (0, 30, 2, 3.0), "b": (0, 20, 1, 1.5)}
    assert run(("b", 19), ("c", 20)) == {"a": (0, 30, 2, 3.0), "b": (0, 39, 2, 3.0), "c": (20, 40, 1, 1.5)}
    assert run(("a", 30), ("a", 50), ("c", 39)) == {"a": (50, 10, 1, 1.5), "b": (0, 39, 2, 3.0), "c": (20, 59, 2, 3.0)}


# Rejects counted in the progress


def test_rejects_are_counted_in_the_progress(spark, folder, tmp_path):  # noqa: F811
    lines = [*sample_lines(60), *sample_lines(9)[-2:], json.dumps({"serviceName": "sendRechargeReq"})]
    for i in range(3):
        folder.put(*lines[i::3])
    sums, out = jobs.kpi_sums(spark, str(tmp_path / "cells")), str(tmp_path / "rejects")
    query = jobs.kpi_stream(folder.stream(spark), sums, str(tmp_path / "cp"), rejects=out)
    jobs.run(query)
    counts = jobs.reject_counts(query)
    log = spark.createDataFrame([(v,) for v in lines], "value string")
    expected = {r["reason"]: r["count"] for r in rejected_records(log).groupBy("reason").count().collect()}
    assert {r: n for r, n in counts.items() if n and r != "good"} == expected and counts["good"] == 60
    assert as_set(spark.read.parquet(out).select("value", "reason")) == as_set(rejected_records(log).select("value", "reason"))
    assert as_set(sums.totals().select("grain", "day", "orders")) == as_set(kpi.all_grains(base_rows(log)).select("grain", "day", "orders"))


def test_kpis_and_rejects_parse_once(spark, folder, tmp_path):  # noqa: F811
    folder.put(record(1), "{bad")
    plans = []

    class Sums:
        run = 0

        def begin(self, checkpoint):
            return self

        def put(self, cells, batch_id, write_time):
            plans.append(cells._jdf.queryExecution().analyzed().toString())
            cells.collect()

        def after_batch(self, batch_id, every):
            pass

    query = jobs.kpi_stream(folder.stream(spark), Sums(), str(tmp_path / "cp"), rejects=str(tmp_path / "rejects"))
    jobs.run(query)
    assert plans and "from_json" not in plans[0]  # the batch is the checked rows already
    assert query.lastProgress.observedMetrics[jobs.CHECKED]["good"] == 1


# An outside store


def stored(path):
    return sorted(r["value"] for r in once.FileStore(path).rows())


def test_rows_reach_an_outside_store_once(spark, folder, tmp_path):  # noqa: F811
    path, runs, checkpoint = str(tmp_path / "store"), str(tmp_path / "runs"), tmp_path / "cp"
    folder.put("a", "b")
    folder.put("c")

    def connect():
        return once.FileStore(path)

    def run():
        jobs.run(once.once_stream(folder.stream(spark), connect, runs, str(checkpoint)))

    run()
    assert stored(path) == ["a", "b", "c"]
    # Published, but Spark did not get to note that the batch was done: it runs the batch again.
    (checkpoint / "commits" / "1").unlink()
    for extra in (checkpoint / "commits").glob(".1.crc"):
        extra.unlink()
    folder.put("d")
    run()
    assert stored(path) == ["a", "b", "c", "d"]
    assert len(list((tmp_path / "store" / "staged").iterdir())) == sum(len(json.loads(b.read_text())) for b in (tmp_path / "store" / "batches").iterdir())


def test_a_failing_task_leaves_nothing_behind(spark, folder, tmp_path):  # noqa: F811
    path, runs, checkpoint = str(tmp_path / "store"), str(tmp_path / "runs"), str(tmp_path / "cp")
    folder.put("a", "bad", "z")
    flag = tmp_path / "mended"

    class Failing(once.FileStore):
        def stage(self, token, rows):
            def checked():
                for row in rows:
                    if row["value"] == "bad" and not flag.exists():
                        raise OSError("lost")
                    yield row

            return super().stage(token, checked())

    with pytest.raises(Exception, match="lost"):
        jobs.run(once.once_stream(folder.stream(spark), lambda: Failing(path), runs, checkpoint))
    assert stored(path) == [] and not list((tmp_path / "store" / "staged").iterdir())
    flag.touch()
    jobs.run(once.once_stream(folder.stream(spark), lambda: Failing(path), runs, checkpoint))
    assert stored(path) == ["a", "bad", "z"]


def test_a_new_run_adds_to_the_outside_store(spark, folder, tmp_path):  # noqa: F811
    path, runs = str(tmp_path / "store"), str(tmp_path / "runs")
    folder.put("a")
    jobs.run(once.once_stream(folder.stream(spark), lambda: once.FileStore(path), runs, str(tmp_path / "cp1")))
    later = Folder(tmp_path / "later")
    later.put("b")
    jobs.run(once.once_stream(later.stream(spark), lambda: once.FileStore(path), runs, str(tmp_path / "cp2")))
    assert stored(path) == ["a", "b"]


# Top words by mergeable sketches


def word_folder(folder, rng, batches, words):  # noqa: F811
    lines = []
    for _ in range(batches):
        some = [" ".join(rng.choice(words) for _ in range(50)) for _ in range(20)]
        lines += some
        folder.put(*some)
    return lines


def exact_top(lines, k):
    counts = Counter(w for line in lines for w in line.split(" "))
    return sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]


def test_top_words_by_sketch_are_exact_on_skewed_words(spark, folder, tmp_path):  # noqa: F811
    rng = random.Random(5)
    words = [f"w{i}" for i in range(1, 8) for _ in range(2000 // i)] + [f"rare{i}" for i in range(4000)]
    store = top.top_store(spark, str(tmp_path / "top"), tracked=256)
    lines = word_folder(folder, rng, 3, words)
    jobs.run(top.top_sketch_stream(folder.stream(spark), store, str(tmp_path / "cp"), compact_every=2))
    assert [tuple(r) for r in top.top_words(store, 5).collect()] == exact_top(lines, 5)
    counts = dict(exact_top(lines, 10**6))
    named, tokens = store[0].named(40)
    assert tokens == sum(counts.values()) and len(counts) > 256
    bound = top.ERROR * tokens / 256
    assert all(counts[w] <= n <= counts[w] + bound for w, n in named)  # never too low, and too high by no more than the bound
    lines += word_folder(folder, rng, 1, ["late", "w1", "w2"])
    jobs.run(top.top_sketch_stream(folder.stream(spark), store, str(tmp_path / "cp"), compact_every=2))
    assert [tuple(r) for r in top.top_words(store, 5).collect()] == exact_top(lines, 5)


def test_top_words_that_a_sketch_cannot_tell_apart(spark, folder, tmp_path):  # noqa: F811
    rng = random.Random(6)
    store = top.top_store(spark, str(tmp_path / "top"), tracked=32)
    assert top.top_words(store, 3).collect() == []
    lines = word_folder(folder, rng, 2, [f"w{i}" for i in range(400)])
    jobs.run(top.top_sketch_stream(folder.stream(spark), store, str(tmp_path / "cp")))
    assert [tuple(r) for r in top.top_words(store, 3).collect()] == exact_top(lines, 3)


# Words in state by bucket


def test_words_share_keys_of_the_state(spark, folder, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(keyed_state, "BUCKETS", 8, raising=False)
    seed = spark.createDataFrame([(f"w{i}", i) for i in range(0, 600, 2)], "word string, n0 bigint")
    latest = jobs.seeded_rows(spark, str(tmp_path / "out"))
    expected = Counter()
    for upto in (400, 500):
        words = [f"w{i}" for i in range(upto)] + ["hot"] * upto
        folder.put(" ".join(words))
        expected.update(words)
        query = keyed_state.seeded_state_stream(folder.stream(spark), seed, latest, str(tmp_path / "cp"))
        jobs.run(query)
        assert held(jobs.seeded_counts(latest)) == {w: n + (int(w[1:]) if w != "hot" and int(w[1:]) % 2 == 0 else 0) for w, n in expected.items()}
        assert query.lastProgress.stateOperators[0].numRowsTotal <= 8

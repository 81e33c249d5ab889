import json
import random

import pytest
from pyspark.sql import functions as F

from kpitide.operators import offsets, vectors, words
from kpitide.sources import files, kafka, ledger, tables

SCHEMA = "topic string, partition int, offset bigint"


def test_topics():
    assert kafka.topic_list(" b, a,,b ") == "a,b"
    assert kafka.topic_list(["x"]) == "x"
    with pytest.raises(ValueError):
        kafka.topic_list(" , ")


def test_read_options():
    cap = kafka.rate_cap(100, partitions=4, batch_seconds=2)
    options = kafka.read_options("h:9092", "b,a", group="g", max_per_batch=cap, min_partitions=16)
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "800",
        "minPartitions": "16",
    }


def test_resume_points(spark):
    stored = spark.createDataFrame(
        [("t", "g", 0, 50), ("t", "g", 1, 5), ("t", "other", 2, 99), ("gone", "g", 0, 1)],
        "topic string, groupid string, partitions int, offset bigint",
    )
    earliest = spark.createDataFrame([("t", 0, 10), ("t", 1, 10), ("t", 2, 7), ("u", 0, 0)], SCHEMA)
    resume = offsets.resume_offsets(offsets.ledger_by_group(stored, "g"), earliest)
    # Stored and still held; stored but no longer held; new partition; new topic. A topic that is gone is not read.
    assert json.loads(kafka.starting_offsets_json(resume)) == {"t": {"0": 50, "1": 10, "2": 7}, "u": {"0": 0}}


def test_ledger_keeps_the_newest_batch_not_the_largest_offset(spark):
    ranges = spark.createDataFrame(
        [("t", "g", 0, 1, 100), ("t", "g", 0, 2, 40)],
        "topic string, groupid string, partition int, batch_id bigint, until_offset bigint",
    )
    assert offsets.upsert_ledger(ranges).first()["offset"] == 40


def test_ledger_rows_from_progress(spark):
    rows = kafka.ledger_from_progress(spark, '{"t":{"1":7,"0":5}}', "g").collect()
    assert sorted(map(tuple, rows)) == [("t", "g", 0, 5), ("t", "g", 1, 7)]


def test_ledger_files(spark, tmp_path):
    path = str(tmp_path / "ledger")
    kafka.ledger_from_progress(spark, {"t": {"0": 5}}, "g").write.parquet(path)
    kafka.ledger_from_progress(spark, {"t": {"0": 9}}, "h").write.mode("append").parquet(path)
    assert [r["offset"] for r in ledger.read_files(spark, path, "h").collect()] == [9]


def test_messages_for_kafka(spark):
    df = spark.createDataFrame([("k1", "v1")], "k string, v string")
    keyed = offsets.assign_partitions(df, "k", 3)
    out = kafka.to_messages(keyed, "v", "k", F.col("partition"))
    assert out.columns == ["key", "value", "partition"]
    assert dict(out.dtypes)["partition"] == "int"


def test_record_line(spark):
    df = spark.createDataFrame([("t", 1, 5, bytearray("é".encode()))], f"{SCHEMA}, value binary")
    row = offsets.record_metadata(df, "consumer: 0").first()
    assert row["line"] == "Consumer: consumer: 0, Topic: t, Offset: 5, msg: é"


def test_read_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x y\n\nz\n")
    assert [r["value"] for r in files.read_lines(spark, str(tmp_path / "a.txt")).collect()] == ["x y", "", "z"]


def test_vector_sum_cuts_to_the_shortest(spark):
    df = spark.createDataFrame(
        [("a", [1, 2, 3]), ("a", [10, 20]), ("b", [5]), ("c", [1, 1]), ("c", []), ("d", [])], "k string, v array<bigint>"
    )
    got = {r["k"]: r["sums"] for r in vectors.vector_sum(df, "k", "v").collect()}
    assert got == {"a": [11, 22], "b": [5], "c": [], "d": []}


def test_running_count_with_a_word_that_is_most_of_the_rows(spark):
    rng = random.Random(7)
    rows = [(i // 10, i % 10, "hot" if rng.random() < 0.7 else rng.choice("abc")) for i in range(5000)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "a bigint, b bigint, word string").repartition(5)
    base = spark.createDataFrame([("hot", 100), ("never", 5)], "word string, n0 bigint")
    counts, expected = {"hot": 100}, {}
    for a, b, word in sorted(rows):
        counts[word] = counts.get(word, 0) + 1
        expected[a, b] = (word, counts[word])
    got = words.running_count(df, "word", ["a", "b"], base=base).collect()
    assert {(r["a"], r["b"]): (r["word"], r["n"]) for r in got} == expected
    assert len(got) == len(rows)


def test_running_count_spreads_the_hot_word(spark, monkeypatch):
    # Blocks come from the order, so one word is in many of them.
    monkeypatch.setattr(words, "scratch_path", lambda *_: path)
    from kpitide.session import scratch_path

    path = scratch_path(spark, "spread")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select(F.col("id"), F.lit("hot").alias("word"))
        assert words.running_count(df, "word", ["id"]).where(F.col("n") != F.col("id") + 1).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("_block").count().collect()]
    assert len(sizes) == 8
    assert max(sizes) < 2 * 20_000 / 8


def test_seed_words_that_do_not_occur_are_left_out(spark):
    counts = spark.createDataFrame([("hello", 2), ("x", 1)], "word string, n bigint")
    seed = spark.createDataFrame([("hello", 1), ("world", 1)], "word string, n0 bigint")
    assert {tuple(r) for r in words.seeded(counts, seed).collect()} == {("hello", 3), ("x", 1)}


def test_top_words_break_ties_by_word(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3)], "word string, n bigint")
    assert [r["word"] for r in words.top_words(counts, 2).collect()] == ["c", "a"]


def test_derived_log_needs_no_shuffle(spark):
    plan = tables.recharge_log(tables.table(spark, "/root/testdata/sf0.001", "events"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan

"""Command line of the streaming jobs, for ``spark-submit``.

Input is a folder of line files (``--files``) or Kafka topics (``--servers`` and ``--topics``); the latter need the
Kafka package of Spark on the cluster.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpitide.operators.keyed import DAY_TTL
from kpitide.operators.offsets import assign_partitions, ledger_by_group, record_metadata, resume_offsets
from kpitide.schemas import seed_words
from kpitide.session import build_session
from kpitide.sources import files, kafka
from kpitide.streaming import event_time, jobs, top


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(prog="kpitide")
    args.add_argument("job", choices=sorted(JOBS))
    args.add_argument("--files", help="folder of line files to read")
    args.add_argument("--files-per-batch", type=int)
    args.add_argument("--servers", help="Kafka brokers")
    args.add_argument("--topics", help="Kafka topics to read, separated by commas")
    args.add_argument("--group", default="kpitide")
    args.add_argument("--starting-offsets", default="earliest", help="earliest, latest, or offsets as JSON")
    args.add_argument("--resume-from", help="ledger folder of an earlier kpi job to go on from, without its checkpoint")
    args.add_argument("--partition-counts", type=json.loads, help="partitions per topic as JSON, for --resume-from")
    args.add_argument("--earliest", type=json.loads, help="earliest offsets held, as JSON topic to partition to offset, for --resume-from")
    args.add_argument("--min-partitions", type=int, help="least number of tasks that read Kafka")
    args.add_argument("--rate", type=int, help="Kafka records per partition and second, with --every and --partition-counts")
    args.add_argument("--skip-lost", action="store_true", help="go on if records were lost at the broker before they were read, instead of stopping")
    args.add_argument("--socket", help="host:port of a line server to read; lines are lost on failure")
    args.add_argument("--rows", type=int, default=10, help="rows the daily job prints of each micro-batch")
    args.add_argument("--print-rows", type=int, default=2**31 - 1, help="records the consume job prints of each micro-batch")
    args.add_argument("--prefix", default="SUCC-", help="prefix of the counters' keys")
    args.add_argument("--width", default="1 minute", help="width of the windows")
    args.add_argument("--delay", help="windows close when no order is this much older than the latest one, such as '10 minutes'; later ones go beside them")
    args.add_argument("--tracked", type=int, help="words that the top-words job keeps sketches of, instead of the counts of all as state")
    args.add_argument("--to-partitions", type=int, help="partitions of the topic produce writes to, chosen by hash of the line")
    args.add_argument("--max-per-batch", type=int, help="Kafka records per micro-batch")
    args.add_argument("--out", required=True, help="folder the job writes to, reachable for all executors")
    args.add_argument("--to-topic", help="Kafka topic the produce job writes to")
    args.add_argument("--every", help="time between micro-batches; without it the job ends when all input is read")
    args.add_argument("--ttl", type=int, help=f"seconds a KPI lives after its last write, such as {DAY_TTL}")
    args.add_argument("--compact-every", type=int, default=100, help="micro-batches between compactions")
    args.add_argument("--delimiter", help="token delimiter of the word counts")
    return args


def seconds_of(duration: str) -> float:
    """``10 minutes`` and the like as seconds."""
    number, unit = duration.split()
    return float(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}[unit.rstrip("s")]


def first_offsets(spark: SparkSession, args: argparse.Namespace) -> str:
    """Stored offsets, but none before the earliest record held, where that is given."""
    if not args.resume_from:
        return args.starting_offsets
    stored = ledger_by_group(jobs.stored_ledger(spark, args.resume_from), args.group)
    points = stored.select("topic", stored["partitions"].alias("partition"), "offset")
    if args.earliest:
        held = [(topic, int(p), int(o)) for topic, at in args.earliest.items() for p, o in at.items()]
        points = resume_offsets(stored, spark.createDataFrame(held, "topic string, partition int, offset bigint"))
    return kafka.starting_offsets_json(points, args.partition_counts)


def raw_lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Kafka records as they come."""
    if not (args.servers and args.topics):
        raise SystemExit("give --files, --socket, or --servers and --topics")
    per_batch = args.max_per_batch
    if args.rate:
        if not (args.every and args.partition_counts):
            raise SystemExit("--rate needs --every and --partition-counts")
        per_batch = kafka.rate_cap(args.rate, sum(args.partition_counts.values()), seconds_of(args.every))
    options = kafka.read_options(
        args.servers,
        args.topics,
        starting_offsets=first_offsets(spark, args),
        max_per_batch=per_batch,
        min_partitions=args.min_partitions,
        skip_lost=args.skip_lost,
    )
    return kafka.read_raw_stream(spark, options)


def lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return files.stream_lines(spark, args.files, args.files_per_batch)
    if args.socket:
        host, port = args.socket.rsplit(":", 1)
        return files.stream_socket(spark, host, int(port))
    return kafka.records(raw_lines(spark, args))


def kpi_job(spark: SparkSession, args: argparse.Namespace) -> list:
    sums = jobs.kpi_sums(spark, f"{args.out}/cells", args.ttl)
    source = lines(spark, args)
    checkpoint = f"{args.out}/checkpoint"
    if not (args.files or args.socket):
        run = sums.begin(checkpoint).run
        spark.streams.addListener(jobs.LedgerListener(spark, f"{args.out}/ledger", args.group, jobs.KPI_QUERY, run))
    rejects = f"{args.out}/rejects"
    return [jobs.kpi_stream(source, sums, checkpoint, args.every, compact_every=args.compact_every, rejects=rejects)]


def last_job(spark: SparkSession, args: argparse.Namespace) -> list:
    latest = jobs.last_kpi_rows(spark, f"{args.out}/last", args.ttl)
    return [jobs.overwrite_stream(lines(spark, args), latest, f"{args.out}/checkpoint", args.every, args.compact_every)]


def windows_job(spark: SparkSession, args: argparse.Namespace) -> list:
    if args.delay:
        store, width_ms = event_time.window_store(spark, f"{args.out}/windows"), int(1000 * seconds_of(args.width))
        job = event_time.closing_window_stream(
            lines(spark, args), store, f"{args.out}/checkpoint", width_ms, args.delay, args.every, args.compact_every
        )
        return [job]
    sums = jobs.window_sums(spark, f"{args.out}/windows")
    return [jobs.window_stream(lines(spark, args), sums, f"{args.out}/checkpoint", args.width, args.every, args.compact_every)]


def daily_job(spark: SparkSession, args: argparse.Namespace) -> list:
    """Prints the totals of each micro-batch and adds to the stored counters."""

    def show(totals: DataFrame, batch_id: int) -> None:
        totals.show(args.rows, truncate=False)

    source = lines(spark, args)
    counters = jobs.counter_sums(spark, f"{args.out}/counters")
    return [
        jobs.daily_totals_stream(
            source, show, f"{args.out}/checkpoint", args.every, counters, args.prefix, args.compact_every
        )
    ]


def words_job(spark: SparkSession, args: argparse.Namespace) -> list:
    out, checkpoint = f"{args.out}/counts", f"{args.out}/checkpoint"
    return [jobs.cumulative_word_stream(lines(spark, args), out, checkpoint, args.delimiter or ",", args.every)]


def top_words_job(spark: SparkSession, args: argparse.Namespace) -> list:
    out, checkpoint = f"{args.out}/counts", f"{args.out}/checkpoint"
    source = lines(spark, args)
    if args.tracked:
        store = top.top_store(spark, out, args.tracked)
        return [top.top_sketch_stream(source, store, checkpoint, args.delimiter or " ", args.every, args.compact_every)]
    return [jobs.top_word_stream(source, out, checkpoint, delimiter=args.delimiter or " ", every=args.every)]


def running_words_job(spark: SparkSession, args: argparse.Namespace) -> list:
    """Lines within a micro-batch are numbered in the order of their text, as they carry no other."""
    out, checkpoint = f"{args.out}/counts", f"{args.out}/checkpoint"
    totals = jobs.word_sums(spark, f"{args.out}/totals")
    source = lines(spark, args).select(F.col("value").alias("line"), "value")
    return [
        jobs.running_word_stream(
            source, ["line"], totals, out, checkpoint, seed_words(spark), args.delimiter or " ", args.every, args.compact_every
        )
    ]


def seeded_words_job(spark: SparkSession, args: argparse.Namespace) -> list:
    latest = jobs.seeded_rows(spark, f"{args.out}/counts")
    return [
        jobs.seeded_word_stream(
            lines(spark, args), seed_words(spark), latest, f"{args.out}/checkpoint", args.delimiter or " ", args.every, args.compact_every
        )
    ]


def consume_job(spark: SparkSession, args: argparse.Namespace) -> list:
    """Prints every record, or the first ``--print-rows`` of each micro-batch."""
    source = lines(spark, args) if args.files or args.socket else record_metadata(raw_lines(spark, args), args.group)
    return [jobs.console_stream(source, f"{args.out}/checkpoint", args.print_rows, every=args.every)]


def produce_job(spark: SparkSession, args: argparse.Namespace) -> list:
    """Lines with themselves as key; with ``--to-partitions`` the key's hash chooses the partition."""
    source = files.stream_lines(spark, args.files, args.files_per_batch)
    partition = None
    if args.to_partitions:
        source, partition = assign_partitions(source, "value", args.to_partitions), "partition"
    checkpoint = f"{args.out}/checkpoint"
    return [jobs.kafka_stream(source, args.servers, args.to_topic, checkpoint, args.every, key="value", partition=partition)]


JOBS = {
    "kpi": kpi_job,
    "daily": daily_job,
    "last": last_job,
    "windows": windows_job,
    "words": words_job,
    "top-words": top_words_job,
    "running-words": running_words_job,
    "seeded-words": seeded_words_job,
    "consume": consume_job,
    "produce": produce_job,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    session = spark or build_session(f"kpitide-{args.job}")
    jobs.watch(JOBS[args.job](session, args))


if __name__ == "__main__":
    main()

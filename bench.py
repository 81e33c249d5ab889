"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of threads, BENCH_QUERIES (comma-separated, or ``all``) other queries.
All queries run once before any is timed. Then they are timed BENCH_RUNS times, every other round in reverse order, and each counts
with its best time. All rows of the result are computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from kpitide.plans import QUERIES
from kpitide.session import build_session
from kpitide.sources.tables import table

HEADLINE = [
    "kpi_daily_overview",
    "kpi_hourly_money",
    "kpi_minute",
    "kpi_province_failure",
    "kpi_hour_province",
    "kpi_grouping_sets",
    "kpi_accumulate",
    "kpi_running",
    "kpi_ttl_live",
    "base_projection",
    "rejected_records",
    "resume_offsets",
    "partition_assign",
    "top10_words",
    "running_word_count",
    "vector_sum",
    "stream_kpi",
    "word_count_cumulative",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(
        "kpitide-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="kpitide-bench-"),
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        seconds(spark, name, sf_dir)
    rounds: dict[str, list[float]] = {name: [] for name in names}
    for n in range(runs):
        for name in names if n % 2 == 0 else names[::-1]:
            rounds[name].append(seconds(spark, name, sf_dir))
    timings = {name: round(min(took), 3) for name, took in rounds.items()}
    for name in names:
        print(f"{name} {timings[name]}", file=sys.stderr)
    report = {
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    if "stream_kpi" in timings:
        events = table(spark, sf_dir, "events").count()
        report["stream_kpi_records_per_sec"] = round(events / timings["stream_kpi"])
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default all
cores), ``BENCH_RUNS`` (default 3), ``BENCH_MEMORY`` (default 16g).

``load_raw_tables`` derives and writes the raw cash-register tables and nothing else; it is
timed once. Every query then runs once to warm up and ``BENCH_RUNS`` times for the
median, from building its plan to its last row. ``a08_returns_without_original``,
``e01_merge_anomalies``, ``e13_flag_cashiers`` and ``week_flags`` compute everything from the raw
tables in every run, writes of intermediate tables included; queries from ``e06`` on that read saved anomalies
and flags find them saved after the warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillwatch.session import STATIC  # noqa: E402
from workload.queries import QUERIES, Week  # noqa: E402

HEADLINES = [
    "a08_returns_without_original",
    "c01_cashier_stats",
    "c03_receipts_outside_hours",
    "c05_voided_cash_receipts",
    "d05_m05",
    "d06_m06",
    "d10_m10",
    "e01_merge_anomalies",
    "e06_thresholds",
    "e11_rank_flags",
    "e13_flag_cashiers",
    "week_flags",
    "f06_run_checks",
    "g09_dense_flag_counts",
    "g13_total_flag_stats",
    "g24_headline",
    "h02_flagged_evidence",
    "h03_weekly_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillwatch-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config(map=STATIC)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(action) -> float:
        began = time.perf_counter()
        action()
        return time.perf_counter() - began

    times = {"load_raw_tables": round(timed(lambda: Week.of(spark, sf_dir)), 3)}
    for name in HEADLINES:

        def run(name: str = name) -> None:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        times[name] = round(statistics.median(timed(run) for _ in range(runs)), 3)
        print(f"{name:32} {times[name]:8.3f} s", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": sf_dir}))


if __name__ == "__main__":
    main()

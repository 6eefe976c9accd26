"""Timings of the headline queries and of the two jobs, as one JSON line.

BENCH_SF_DIR   directory of test tables (default /root/testdata/sf0.1)
BENCH_CPUS     threads of the local session (default 8)
BENCH_RUNS     timed runs per entry, of which the median counts (default 3)

Making the raw records and the CSV directory is set-up and is not timed. Each
entry runs once untimed before. Jobs and shuffled bytes are in ``details``.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import tempfile
import time
import warnings

from pyspark.sql import DataFrame, SparkSession

from scrubline import catalogue
from scrubline.catalogue.fixture import csv_folder
from scrubline.plans import CleanseConfig, cleanse, profile
from scrubline.plans.cleansing import SALES_SCHEMA
from scrubline.sources import read_csv_dir

QUERIES = [
    "cleanse_keep_latest",
    "clean_rows",
    "reject_summary",
    "null_counts",
    "distinct_counts",
    "key_duplicate_count",
    "exact_duplicate_count",
    "duplicate_members",
    "drop_exact",
    "dedup_summary",
    "castability",
    "quality_checks",
    "events_latest",
    "documents_exact_text_duplicates",
]


def session(cpus: str, scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("scrubline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


class Meter:
    """Seconds, Spark jobs and shuffled bytes of a piece of work."""

    def __init__(self, spark: SparkSession, runs: int):
        self.context, self.runs, self.details = spark.sparkContext, runs, {}

    def measure(self, name: str, work) -> float:
        seconds = []
        work()
        for i in range(self.runs):
            group = f"{name}-{i}"
            self.context.setJobGroup(group, name)
            start = time.perf_counter()
            work()
            seconds.append(time.perf_counter() - start)
        tracker, store = self.context.statusTracker(), self.context._jsc.sc().statusStore()
        jobs = tracker.getJobIdsForGroup(group)
        stages = {s for job in jobs for s in tracker.getJobInfo(job).stageIds}
        shuffled = sum(store.lastStageAttempt(s).shuffleWriteBytes() for s in stages)
        self.details[name] = {"jobs": len(jobs), "shuffle_mb": round(shuffled / 2**20, 2)}
        return round(statistics.median(seconds), 3)


def main() -> None:
    warnings.simplefilter("ignore")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="scrubline-bench-")
    spark = session(os.environ.get("BENCH_CPUS", "8"), scratch)
    try:
        queries = catalogue.queries()
        source = csv_folder(spark, sf_dir)
        meter = Meter(spark, runs)
        times = {
            name: meter.measure(name, lambda: run_all(queries[name](spark, sf_dir))) for name in QUERIES
        }
        times["csv_scan"] = meter.measure(
            "csv_scan", lambda: run_all(read_csv_dir(spark, source, SALES_SCHEMA))
        )
        times["cleanse_job"] = meter.measure(
            "cleanse_job", lambda: cleanse(spark, source, f"{scratch}/out/staged")
        )
        times["cleanse_job_observed"] = meter.measure(
            "cleanse_job_observed",
            lambda: cleanse(spark, source, f"{scratch}/out/observed", CleanseConfig(metrics="observed")),
        )
        times["profile_job"] = meter.measure("profile_job", lambda: profile(spark, source).collect())
        print(
            json.dumps(
                {
                    "metric": "total_query_seconds",
                    "value": round(sum(times.values()), 3),
                    "unit": "sec",
                    "queries": times,
                    "sf": os.path.basename(sf_dir).removeprefix("sf"),
                    "details": meter.details,
                }
            )
        )
    finally:
        spark.stop()
        shutil.rmtree(scratch, ignore_errors=True)


if __name__ == "__main__":
    main()

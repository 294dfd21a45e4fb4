"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each run builds a query and executes it in full. All queries run once to warm up the JVM;
then each runs once more and BENCH_RUNS times for its median.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from testbed.registry import queries

HEADLINE = [
    "kpi_daily",
    "kpi_daily_window",
    "kpi_daily_changepoints",
    "retention_cohorts",
    "retention_engagement",
    "scd2_merge_subscriptions",
    "scd2_merge_customers",
    "invoices_silver",
    "subscriptions_silver",
    "events_silver",
    "fact_daily",
    "fk_orphans",
]


#: Settings beside those of a plain session; printed with the result.
def settings(cpus: str) -> dict[str, str]:
    return {
        "spark.driver.memory": "12g",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": cpus,
        # One small file is one task and one megabyte one partition by default; both would
        # leave most cores idle at this scale.
        "spark.sql.files.maxPartitionBytes": "4m",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tenure-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=settings(cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()

    def run(name: str) -> float:
        started = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    for name in HEADLINE:
        run(name)
    timings = {}
    for name in HEADLINE:
        run(name)
        timings[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, total of medians",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "settings": settings(cpus),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

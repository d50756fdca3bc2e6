"""Time the headline queries: median of warm runs, each written to a no-op sink."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from slotledger.workload.queries import QUERIES

HEADLINE = [
    "resolve_requests",
    "day_slots",
    "week_slots",
    "scan_event_log",
    "hourly_rollup_closed",
    "component_rollup",
    "daily_rollup",
    "insert_new_exact",
    "insert_new_approx",
    "first_per_key",
    "latest_per_agent",
    "latest_audit_join",
    "latest_stamp_weekly",
    "join_back_latest",
    "memory_installed",
    "eav_pivot",
    "widen_conversations",
    "components_report",
    "events_report",
    "weekly_disk_report",
    "current_disk_report",
    "servers_snapshot",
]
RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times: dict[str, float] = {}
    for name in names:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(RUNS)), 4)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_time_headline_queries",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()

"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Each query runs to completion through the ``noop``
sink (all the work, no output I/O) after one warm-up pass over the fixture.
Every query runs twice; ``queries`` holds the faster (JIT-warm) run and
``cold`` the first one.  ``value`` is the sum of the warm per-query seconds.  ``stages`` repeats the
original pipeline's throughput measurement (read, dedup, route, aggregate;
rows in per second) on the whole listing view and on 10,000 of its rows (the
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = (
    "agg_generic",
    "route_basic",
    "dedup_first",
    "dedup_by_join",
    "report_market_trends",
    "report_property_type_size",
    "report_time_yearly",
    "report_broker",
    "validate_all",
    "validation_error_counts",
    "quality_report",
    "duplicate_groups",
    "profile_table",
    "clean_full",
    "dedup_text",
    "end_to_end",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    event_dir = tempfile.mkdtemp(prefix="rowmill-bench-events-")  # scratch folder for Spark's event log
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rowmill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", event_dir)
        .config("spark.eventLog.compress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    from rowmill.plans.fixtures import listings
    from rowmill.plans.registry import QUERIES
    from rowmill.plans.throughput import measure, timed

    def run(name: str) -> float:
        spark.sparkContext.setJobGroup(name, name)
        start = time.perf_counter()  # building a query may store a table it reads more than once
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        spark.sparkContext.setJobGroup("other", "other")
        return seconds

    listings(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up: JVM, file listing, codegen
    cold, times = {}, {}
    for name in HEADLINE:
        first, second = run(name), run(name)
        cold[name] = round(first, 3)
        times[name] = round(min(first, second), 3)

    stages, stages_10k = {}, {}
    for r in measure(spark, listings(spark, sf_dir), sizes=(-1, 10000)).collect():
        target = stages if r["size"] == "all" else stages_10k
        target[r["stage"]] = {"seconds": r["seconds"], "records": r["records"], "rps": r["rps"]}

    # what any aggregate over a shuffle costs in this session, however few its rows
    one = spark.range(1, numPartitions=cpus).selectExpr("id % 2 as k", "id").persist()
    fixed = min(timed(one.groupBy("k").sum("id"))[0] for _ in range(4))

    spark.stop()
    try:
        balance = task_balance(event_dir, HEADLINE)
    except Exception as exc:  # noqa: BLE001 - the measurement must still be printed
        balance = {"error": str(exc)[:200]}

    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold_total": round(sum(cold.values()), 3),
        "cold": cold,
        "stages": stages,
        "stages_10000_rows": stages_10k,
        "one_row_aggregate_seconds": round(fixed, 4),
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "task_balance": balance,
    }))


def task_balance(event_dir: str, names) -> dict:
    """Per query, from Spark's event log: task count, median and maximum task seconds
    (over both runs).  A maximum far above the median would point at a skewed task."""
    group_of_job, job_of_stage, tasks = {}, {}, {}
    for path in glob.glob(os.path.join(event_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue  # Spark 4 writes rolling logs: eventlog_v2_<app>/events_<n>_<app>
        with open(path) as fh:
            for line in fh:
                if not line.startswith("{"):
                    continue
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    group_of_job[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        job_of_stage[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    info = ev.get("Task Info", {})
                    secs = (info.get("Finish Time", 0) - info.get("Launch Time", 0)) / 1000.0
                    tasks.setdefault(ev["Stage ID"], []).append(secs)
    per_group: dict[str, list[float]] = {}
    for sid, durations in tasks.items():
        group = group_of_job.get(job_of_stage.get(sid))
        if group in names:
            per_group.setdefault(group, []).extend(durations)
    return {
        g: {"tasks": len(d), "p50_task_s": round(statistics.median(d), 3), "max_task_s": round(max(d), 3)}
        for g, d in per_group.items() if d
    }


if __name__ == "__main__":
    main()

"""Run operators while the first attempt of some tasks fails, then compare with a clean run.

Started by tests/test_fault_tolerance.py in its own process (local[4,4]: up to 4 attempts
per task).  A Python UDF -- test-only failure injection -- raises on attempt 0 of chosen
partitions, so Spark recomputes those tasks; the results must equal the failure-free ones.
"""

import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rowmill.operators import dedup, dedup_by_join  # noqa: E402
from rowmill.operators.quantile import percentile_disc  # noqa: E402
from rowmill.plans.end_to_end import PipelineOptions, run  # noqa: E402

spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "6")
         .getOrCreate())
spark.sparkContext.setLogLevel("OFF")


@F.udf("boolean")
def flaky(_):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return True


base = spark.read.parquet(f"{sys.argv[2]}/lineitem.parquet").repartition(4, "l_orderkey")
faulty = base.filter(flaky(F.col("l_orderkey")))
keys = ["l_partkey", "l_suppkey"]


def rows(df):
    return sorted(map(tuple, df.collect()))


def failed_tasks(group):
    tracker = spark.sparkContext.statusTracker()
    total = 0
    for job in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(job)
        for stage in (info.stageIds if info else []):
            st = tracker.getStageInfo(stage)
            total += st.numFailedTasks if st else 0
    return total


checks = {
    "dedup": lambda src: dedup(src, keys),
    "dedup_by_join": lambda src: dedup_by_join(src, keys),
    "percentile": lambda src: percentile_disc(src, ["l_returnflag"], "l_extendedprice"),
}
for name, build in checks.items():
    expected = rows(build(base))
    spark.sparkContext.setJobGroup(f"faulty-{name}", name)  # building may run jobs too (eager checkpoint)
    got = rows(build(faulty))
    spark.sparkContext.setJobGroup("clean", "clean")
    assert got == expected, name
    assert failed_tasks(f"faulty-{name}") > 0, f"{name}: no task failure was injected"
listing = base.selectExpr("cast(l_orderkey as string) as street", "'c' as city", "l_returnflag as state",
                          "cast(l_partkey as string) as zip_code", "l_extendedprice as price")
faulty_listing = listing.filter(flaky(F.col("street")))
opts = PipelineOptions(keys=["street", "city", "state", "zip_code"], reports=("status_analysis",))
expected = rows(run(listing, opts)["annotated"])
spark.sparkContext.setJobGroup("faulty-end_to_end", "end_to_end")  # run() writes its fork point: jobs at build time
got = rows(run(faulty_listing, opts)["annotated"])
assert got == expected, "end_to_end"
assert failed_tasks("faulty-end_to_end") > 0, "end_to_end: no task failure was injected"
print("task-retry checks passed")

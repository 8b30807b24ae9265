"""10x probe: the listing view and ten unioned copies of it (every key ten times),
written once to the shared checkpoint folder, then the main operators on both.

usage: python tools/scale_probe.py [SF_DIR]
"""

from __future__ import annotations

import sys
import time
from functools import reduce

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import SparkSession  # noqa: E402

from rowmill.operators import annotate, dedup, quality_report, validation_counts  # noqa: E402
from rowmill.operators.reports import run_reports  # noqa: E402
from rowmill.plans.fixtures import listings  # noqa: E402
from rowmill.sinks import shared_dir  # noqa: E402


def best_of_two(df) -> float:
    best = float("inf")
    for _ in range(2):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return best


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "64")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    one, ten = shared_dir(spark, "x1"), shared_dir(spark, "x10")
    listings(spark, sf).write.parquet(one)
    reduce(lambda a, b: a.unionByName(b), [spark.read.parquet(one)] * 10).write.parquet(ten)
    keys = ["street", "city", "state", "zip_code"]
    for label, path in (("x1", one), ("x10", ten)):
        df = spark.read.parquet(path)
        res = {
            "dedup": best_of_two(dedup(df, keys)),
            "validate": best_of_two(validation_counts(annotate(df))),
            "quality": best_of_two(quality_report(df)),
            "market_trends": best_of_two(run_reports(df, ["market_trends"], scale=2)["market_trends"]),
            "status": best_of_two(run_reports(df, ["status_analysis"], scale=2)["status_analysis"]),
        }
        print(label, df.count(), {k: round(v, 2) for k, v in res.items()})
    spark.stop()


if __name__ == "__main__":
    main()

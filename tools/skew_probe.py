"""Hot-key probe: dedup, exact median, quality report and a group-by with uniform keys
vs. one key holding a third of the rows (derived from lineitem; nothing is registered).

usage: python tools/skew_probe.py [SF_DIR]
"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rowmill.operators import QualitySpec, dedup, quality_report  # noqa: E402
from rowmill.operators.quantile import percentile_disc  # noqa: E402


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
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "16")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    frames = {
        "uniform": li.withColumn("k", F.col("l_partkey")),
        "hot": li.withColumn("k", F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_partkey"))),
    }
    spec = QualitySpec(required=("k",), unique_keys=("k",), minimum={}, max_null_fraction={})
    for name, df in frames.items():
        hot_rows = df.filter("k = -1").count()
        res = {
            "dedup": best_of_two(dedup(df, ["k"])),
            "exact_median": best_of_two(percentile_disc(df, ["k"], "l_extendedprice", 0.5)),
            "quality_unique": best_of_two(quality_report(df, spec)),
            "groupby_avg": best_of_two(df.groupBy("k").agg(F.avg("l_extendedprice"))),
        }
        print(name, f"rows in hot key: {hot_rows}", {k: round(v, 2) for k, v in res.items()})
    spark.stop()


if __name__ == "__main__":
    main()

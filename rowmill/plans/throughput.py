"""Records per second for each pipeline stage.

Stages are isolated: each stage reads the *persisted* output of the previous
one, is materialised through the ``noop`` sink (all work, no output I/O), and
counts its own output rows with an ``Observation`` in the same job.  So a
stage's time is its own work, not a re-run of the stages before it.  Rates are
rows *in* divided by seconds.  The Spark settings that shape the plan are
recorded next to every measurement.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowmill.operators.dedup import dedup, detect_keys
from rowmill.operators.limit import SMALL, take_any, take_ordered
from rowmill.operators.reports import segment_state
from rowmill.operators.route import apply_rule_set
from rowmill.sinks.scratch import shared_dir

SCHEMA = (
    "size string, stage string, seconds double, records bigint, rps double, "
    "aqe string, skew_join string, shuffle_partitions string, broadcast_threshold string"
)

_CONFS = (
    ("aqe", "spark.sql.adaptive.enabled"),
    ("skew_join", "spark.sql.adaptive.skewJoin.enabled"),
    ("shuffle_partitions", "spark.sql.shuffle.partitions"),
    ("broadcast_threshold", "spark.sql.autoBroadcastJoinThreshold"),
)


def _conf(spark: SparkSession, key: str) -> str:
    try:
        return str(spark.conf.get(key))
    except Exception:  # noqa: BLE001 - unset keys without a default
        return ""


def timed(df: DataFrame) -> tuple[float, int]:
    """Run ``df`` to completion through the noop sink; (seconds, rows out)."""
    obs = Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    start = time.perf_counter()
    observed.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    return seconds, int(obs.get["rows"])


def _persisted(df: DataFrame) -> tuple[DataFrame, float, int]:
    p = df.persist(StorageLevel.MEMORY_AND_DISK)
    seconds, rows = timed(p)
    return p, seconds, rows


def _written(df: DataFrame) -> tuple[DataFrame, float, int]:
    """Hand-off through Parquet in the shared folder: the stage time includes the write."""
    spark = df.sparkSession
    path = shared_dir(spark, "throughput")
    obs = Observation()
    start = time.perf_counter()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    seconds = time.perf_counter() - start
    return spark.read.parquet(path), seconds, int(obs.get["rows"])


def _sample(df: DataFrame, size: int, order_by: Sequence[str] | None) -> DataFrame:
    """``size`` rows; the few of a small size come in one partition and are spread again, so that the timed
    stages run with the session's parallelism, not as single tasks."""
    rows = take_ordered(df, size, order_by) if order_by else take_any(df, size)
    return rows.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SMALL else rows


def measure(
    spark: SparkSession,
    df: DataFrame,
    sizes: Sequence[int] = (-1,),
    keys: Sequence[str] | None = None,
    rule_set: str = "preset_basic",
    handoff: str = "persist",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per (size, stage); size ``<= 0`` means the whole input ("all").

    ``handoff`` is how a stage's output reaches the next stage: ``persist``
    (executor memory and local disk; fine for samples and local runs) or
    ``write`` (Parquet in the shared checkpoint folder; the scale-safe choice
    for a whole large table, and the stage time then includes the write).
    With ``order_by`` a size keeps the first rows in that order instead of any.
    """
    if handoff not in ("persist", "write"):
        raise ValueError("handoff must be 'persist' or 'write'")
    keep = _persisted if handoff == "persist" else _written
    conf = {name: _conf(spark, key) for name, key in _CONFS}
    keys = list(keys) if keys else detect_keys(df, required=False)
    records: list[tuple] = []
    for size in sizes:
        label = "all" if size is None or size <= 0 else str(size)
        src = df if label == "all" else _sample(df, int(size), order_by)
        held: list[DataFrame] = []
        try:
            read, t, n_in = keep(src)
            held.append(read)
            records.append((label, "read", t, n_in, n_in))
            if keys:
                deduped, t, n = keep(dedup(read, keys))
                held.append(deduped)
                records.append((label, "dedup", t, n, n_in))
            else:
                deduped = read
            routed, t, n = keep(apply_rule_set(deduped, rule_set))
            held.append(routed)
            records.append((label, "route", t, n, n_in))
            t, n = timed(segment_state(routed))
            records.append((label, "aggregate", t, n, n_in))
        finally:
            for h in held:
                if handoff == "persist":
                    h.unpersist()
    rows = [
        (size, stage, round(sec, 4), int(out), round(n_in / sec, 2) if sec > 0 else 0.0,
         conf["aqe"], conf["skew_join"], conf["shuffle_partitions"], conf["broadcast_threshold"])
        for size, stage, sec, out, n_in in records
    ]
    return spark.createDataFrame(rows, SCHEMA)

"""Exact discrete percentile per group without buffering a group in one task.

``percentile_disc(p)`` is the smallest value ``v`` of a group whose cumulative
count reaches ``p * n``.  Spark's own ``percentile_disc`` aggregate keeps every
distinct value of a group in one buffer, so a group holding a third of the
data would have to fit one task.  Here the cumulative count is computed as a
distributed prefix sum instead:

1. ``(group, value) -> count``: a hash aggregate with map-side combining.
2. ``repartitionByRange(group, value)``: a hot group is cut by value into many
   range partitions; every partition holds a contiguous run of (group, value).
3. Per (partition, group) totals -- at most ``groups + partitions`` rows -- give
   each run its offset (a window over that small table) and each group its n.
4. Running sum inside each (partition, group) run plus its offset is the exact
   cumulative count; the first value reaching ``p * n`` is the answer.

No step holds more than one range partition of distinct values per task.

Steps 3 and 4 both read the range-partitioned table; Spark reuses that one
exchange (``ReusedExchange``), so both see the same partition ids.  When
exchange reuse is switched off the table is cut with a reliable
``checkpoint()`` into the shared checkpoint folder instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.functions.names import named
from rowmill.sinks.scratch import ensure_checkpoint_dir

_V, _C, _PID, _T, _OFF, _N, _CUM = "__q_v", "__q_c", "__q_pid", "__q_t", "__q_off", "__q_n", "__q_cum"


def percentile_disc(
    df: DataFrame,
    group_by: Sequence[str],
    value: Column | str,
    p: float = 0.5,
    alias: str = "percentile",
    partitions: int | None = None,
) -> DataFrame:
    """One row per group with a non-null value: ``group_by..., alias``."""
    v = named(value) if isinstance(value, str) else value
    g = list(group_by)
    counts = (
        df.select(*[named(c) for c in g], v.alias(_V))
        .filter(F.col(_V).isNotNull())
        .groupBy(*g, _V)
        .agg(F.count(F.lit(1)).alias(_C))
    )
    return percentile_from_counts(counts, g, _V, _C, p, alias, partitions)


def percentile_from_counts(
    counts: DataFrame,
    group_by: Sequence[str],
    value: str,
    count: str,
    p: float = 0.5,
    alias: str = "percentile",
    partitions: int | None = None,
) -> DataFrame:
    """Steps 2-4 over a ``(group..., value, count)`` table with non-null values."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be within [0, 1]")
    spark = counts.sparkSession
    nparts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = list(group_by)
    counts = counts.select(*[named(c) for c in g], named(value).alias(_V), named(count).alias(_C))
    # an explicit partition count: AQE leaves such a repartition as it is, so both readers of
    # the exchange below see the same partitions (coalescing could merge them differently per reader)
    ranged = counts.repartitionByRange(nparts, *[named(c).asc_nulls_first() for c in g], F.col(_V).asc())
    ranged = ranged.withColumn(_PID, F.spark_partition_id())
    if str(spark.conf.get("spark.sql.exchange.reuse", "true")).lower() != "true":
        # both consumers below must see the same range partitions; with exchange reuse
        # off they would each re-sample the bounds, so cut the lineage in the shared folder
        ensure_checkpoint_dir(spark)
        ranged = ranged.checkpoint(eager=True)

    runs = ranged.groupBy(_PID, *g).agg(F.sum(_C).alias(_T))
    before = Window.partitionBy(*g).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        _PID, *g,
        F.coalesce(F.sum(_T).over(before), F.lit(0)).alias(_OFF),
        F.sum(_T).over(Window.partitionBy(*g)).alias(_N),
    )
    r, o = ranged.alias("__q_r"), runs.alias("__q_o")
    cond = [F.col(f"__q_r.{_PID}") == F.col(f"__q_o.{_PID}")]
    cond += [F.col(f"__q_r.`{c}`").eqNullSafe(F.col(f"__q_o.`{c}`")) for c in g]
    joined = r.join(o, cond, "inner").select(
        F.col(f"__q_r.{_PID}").alias(_PID), *[F.col(f"__q_r.`{c}`").alias(c) for c in g],
        F.col(f"__q_r.{_V}").alias(_V), F.col(f"__q_r.{_C}").alias(_C),
        F.col(f"__q_o.{_OFF}").alias(_OFF), F.col(f"__q_o.{_N}").alias(_N),
    )

    within = Window.partitionBy(_PID, *g).orderBy(_V).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = joined.withColumn(_CUM, F.col(_OFF) + F.sum(_C).over(within))
    hit = cum.filter(F.col(_CUM) >= F.lit(float(p)) * F.col(_N))
    return hit.groupBy(*g).agg(F.min(_V).alias(alias))


def attach(base: DataFrame, extra: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left-join per-group ``columns`` of ``extra`` onto ``base`` (null-safe keys), keeping base order."""
    b, e = base.alias("__a_b"), extra.alias("__a_e")
    cond = [F.col(f"__a_b.`{k}`").eqNullSafe(F.col(f"__a_e.`{k}`")) for k in keys]
    return b.join(e, cond, "left").select(
        *[F.col(f"__a_b.`{c}`").alias(c) for c in base.columns], *[F.col(f"__a_e.`{c}`").alias(c) for c in columns]
    )

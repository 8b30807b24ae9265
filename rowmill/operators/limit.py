"""The first n rows, exactly, without bringing n rows into one task.

Spark's ``limit`` over a sort merges the n best rows of every task in a single one.  That is the
right plan for a small n and is kept up to ``SMALL``.  Beyond it the rows are range-partitioned by
the order and sorted inside the ranges; every row then has a place, its range and its number in it, as
one long.  The ranges' row counts (one number a range) tell in which range the n-th row lies and
where, so the cut is a filter on one column that reaches the Parquet scan: ranges
before the cut are kept whole, one is cut, the files of those behind it are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, VariantType

from rowmill.functions.names import named
from rowmill.sinks.scratch import stored

#: Up to so many rows Spark's own top-n is used: each task keeps so many at most, and one merges them.
SMALL = 10_000

_AT, _TIE = "__limit_at", "__limit_tie"
_RANGE_BITS = 33  # of monotonically_increasing_id: the partition stands above them


def _sortable(t: DataType) -> bool:
    return not isinstance(t, (MapType, VariantType))


def order_of(df: DataFrame, order_by: Sequence[str] | None) -> list[Column]:
    """The given columns, then all others that can be ordered, ascending with nulls first: a
    repeatable order, whose ties are between equal rows."""
    first = list(order_by or ())
    rest = [f.name for f in df.schema.fields if f.name not in set(first) and _sortable(f.dataType)]
    return [named(c).asc_nulls_first() for c in [*first, *rest]]


def take_ordered(df: DataFrame, n: int, order_by: Sequence[str] | None = None, small: int = SMALL) -> DataFrame:
    """First ``n`` rows in a repeatable order (all columns by default); ``n <= 0`` keeps all."""
    if n is None or n <= 0:
        return df
    order = order_of(df, order_by)
    if n <= small:
        return df.orderBy(*order).limit(int(n))
    # equal rows are told apart by a tie-breaker, so that one value of many rows spreads over ranges
    keyed = df.withColumn(_TIE, F.monotonically_increasing_id())
    order = [*order, F.col(_TIE).asc()]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop(_TIE)
    return _cut(ranged, int(n), df.columns)


def take_any(df: DataFrame, n: int, small: int = SMALL) -> DataFrame:
    """``n`` rows of ``df``, whichever come first in its partitions; ``n <= 0`` keeps all.  No row is sorted or
    moved beyond ``small`` rows."""
    if n is None or n <= 0:
        return df
    return df.limit(int(n)) if n <= small else _cut(df, int(n), df.columns)


def _cut(df: DataFrame, n: int, columns: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by partition and place in it."""
    spark = df.sparkSession
    placed = stored(df.withColumn(_AT, F.monotonically_increasing_id()), "limit")
    return placed.where(F.col(_AT) < F.lit(_bound(spark, placed, n))).select(*[named(c) for c in columns])


def _bound(spark: SparkSession, placed: DataFrame, n: int) -> int:
    """The place of the first row behind the cut, from one count for each partition."""
    counts = placed.groupBy(F.shiftright(_AT, _RANGE_BITS).alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    left = n
    for r in sorted(counts.collect()):
        if left <= r["rows"]:
            return (r["part"] << _RANGE_BITS) + left
        left -= r["rows"]
    return (1 << 63) - 1

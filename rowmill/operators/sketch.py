"""Mergeable quantile sketches: a KLL sketch a group, stored and merged across runs.

A sketch has a bounded size whatever the group's, is built by partial aggregation (a hot group leaves
a task as one sketch) and answers any quantile within a rank error that its size sets.  Sketches of
increments merge, so a quantile over a year of data is read from a year's sketches.  For exact
quantiles see :mod:`rowmill.operators.quantile`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.names import named

#: Size parameter of the sketch: about 0.35 % rank error, some 7 KB a group.
SIZE = 800
#: Rank error that is exceeded hardly ever at that size (three times the one stated).
RANK_ERROR = 0.01


def quantile_sketches(df: DataFrame, group_by: Sequence[str], value: Column | str, size: int = SIZE) -> DataFrame:
    """``group_by..., n, sketch``: the sketch of each group's non-null values, and their number.  A group without any
    value has no row."""
    v = (named(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*[named(c) for c in group_by], v.alias("__v")).where(F.col("__v").isNotNull())
    return rows.groupBy(*[named(c) for c in group_by]).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("__v", size).alias("sketch"))


def merge_sketches(sketches: Sequence[DataFrame], group_by: Sequence[str], size: int = SIZE) -> DataFrame:
    """Sketches of all rows behind those given."""
    both = reduce(DataFrame.unionByName, sketches)
    return both.groupBy(*[named(c) for c in group_by]).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", size).alias("sketch"))


def quantile_of(sketches: DataFrame, p: float = 0.5, alias: str = "percentile") -> DataFrame:
    """``sketches`` with the estimate of quantile ``p`` in place of the sketch."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be within [0, 1]")
    return sketches.withColumn(alias, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).drop("sketch")


def rank_errors(df: DataFrame, group_by: Sequence[str], value: Column | str, estimates: DataFrame, estimate: str,
                p: float = 0.5) -> DataFrame:
    """``group_by..., n, error``: how far ``estimate`` is from quantile ``p`` of each group, as a share of its values.

    An estimate stands for all ranks that its value has in the group, from the values below it to those
    not above it; the error is the distance of ``p`` from them.
    """
    v = (named(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*[named(c).alias(f"__g{i}") for i, c in enumerate(group_by)], v.alias("__v")).where(F.col("__v").isNotNull())
    own = estimates.select(*[named(c) for c in group_by], named(estimate).alias("__e"))
    same = reduce(Column.__and__, [F.col(f"__g{i}").eqNullSafe(named(c)) for i, c in enumerate(group_by)])
    ranks = rows.join(own, same).groupBy(*[named(c) for c in group_by]).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("__v") < F.col("__e")).alias("__below"), F.count_if(F.col("__v") <= F.col("__e")).alias("__upto"))
    low, high = F.col("__below") / F.col("n"), F.col("__upto") / F.col("n")
    return ranks.select(*[named(c) for c in group_by], "n", F.greatest(F.lit(0.0), low - F.lit(p), F.lit(p) - high).alias("error"))

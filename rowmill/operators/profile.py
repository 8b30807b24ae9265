"""Table inspection: per-column profile from one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.names import named


def profile(df: DataFrame) -> DataFrame:
    """``(position, column, type, rows, nulls)`` for every column, from one aggregate."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(named(f.name).isNull()).alias(f"__n{i}") for i, f in enumerate(fields)
    ]
    stats = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("__rows").alias("rows"),
            F.col(f"__n{i}").alias("nulls"),
        )
        for i, f in enumerate(fields)
    ]
    return stats.select(F.inline(F.array(*rows)))

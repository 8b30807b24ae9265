"""Quality checks over a table that grows: counters and key digests that add up.

The state of some rows is a small table: the counters of the report, and of each different key a 128-bit
digest with its number of rows.  States of two sets of rows add up to that of their union, so a
table kept in increments (days, files, batches) is checked by reading the data of a new increment
alone; the report comes from the states.  Uniqueness holds across increments, since the digests do.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.names import named
from rowmill.operators.quality import QualitySpec, counters, report_of
from rowmill.sinks.scratch import hadoop_path

STATE = "counter string, digest binary, n bigint"


def check_state(df: DataFrame, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """``STATE`` of the rows of ``df``: a row for each counter, and one for each different key.

    One scan counts, a second reads the key columns; the shuffle carries 16 bytes and a count a key,
    folded map-side.  Keys are told apart by an MD5 over their values as JSON, nulls included, so null
    keys group together.
    """
    names = ["total", *(n for n, _ in counters(df, spec))]
    totals = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(p).alias(n) for n, p in counters(df, spec)])
    pairs = F.array(*[F.struct(F.lit(n).alias("counter"), F.lit(None).cast("binary").alias("digest"), F.col(n).alias("n")) for n in names])
    state = totals.select(F.inline(pairs))
    keys = list(spec.unique_keys)
    if not keys or not all(k in df.columns for k in keys):
        return state
    whole = F.to_json(F.struct(*[named(k).alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"})
    digests = df.groupBy(F.unhex(F.md5(whole)).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return state.unionByName(digests.select(F.lit(None).cast("string").alias("counter"), "digest", "n"))


def merge_states(states: Sequence[DataFrame]) -> DataFrame:
    """The state of all rows together."""
    return reduce(DataFrame.unionByName, states).groupBy("counter", "digest").agg(F.sum("n").alias("n"))


def report_from_state(state: DataFrame, columns: Sequence[str], spec: QualitySpec = QualitySpec()) -> DataFrame:
    """The report that :func:`rowmill.operators.quality_report` gives for the rows behind ``state``, which may be a
    plain union of states; ``columns`` are the table's."""
    unique = bool(spec.unique_keys) and all(k in columns for k in spec.unique_keys)
    names = ["total"]
    for short, own in (("req", spec.required), ("nul", spec.max_null_fraction), ("min", spec.minimum), ("max", spec.maximum)):
        names += [f"{short}{i}" for i, c in enumerate(own) if c in columns]
    sums = state.where("counter is not null").agg(*[F.coalesce(F.sum(F.when(F.col("counter") == n, F.col("n"))), F.lit(0)).alias(n) for n in names])
    if unique:
        per_key = state.where("digest is not null").groupBy("digest").agg(F.sum("n").alias("n"))
        both = sums.unionByName(per_key.agg(F.count_if(F.col("n") > 1).alias("dup_groups")), allowMissingColumns=True)
        sums = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return report_of(sums, spec, columns, unique)


class QualityStore:
    """States of a table's increments under one folder.  An increment that is added again replaces its state."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], spec: QualitySpec = QualitySpec()):
        self.spark, self.path, self.columns, self.spec = spark, path.rstrip("/"), list(columns), spec

    def add(self, increment: str, df: DataFrame) -> None:
        """Check the rows of a new increment."""
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise ValueError(f"increment {increment!r} lacks the columns {missing}")
        check_state(df.select(*[named(c) for c in self.columns]), self.spec).write.mode("overwrite").parquet(self._at(increment))

    def drop(self, increment: str) -> None:
        fs, at = hadoop_path(self.spark, self._at(increment))
        fs.delete(at, True)

    def report(self) -> DataFrame:
        """The report of all increments together, from their states alone."""
        fs, at = hadoop_path(self.spark, self.path)
        if not fs.exists(at) or not fs.listStatus(at):
            return report_from_state(self.spark.createDataFrame([], STATE), self.columns, self.spec)
        return report_from_state(self.spark.read.schema(STATE).parquet(f"{self.path}/increment=*"), self.columns, self.spec)

    def _at(self, increment: str) -> str:
        if not increment or any(c in increment for c in "/*?[]{}\\"):
            raise ValueError(f"{increment!r} can't name a folder")
        return f"{self.path}/increment={increment}"

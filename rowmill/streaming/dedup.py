"""One row per key over a stream, in any order of arrival.

The winner of a key is the smallest row in the order that :func:`rowmill.operators.dedup` uses, so it is
a minimum: the stream is grouped by key and keeps that minimum in Spark's state store, one
row a key.  A batch gives the keys whose winner it changed.  These changes are written a folder per
batch, replaced if a batch is replayed; the table of winners is the best change of each key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rowmill.functions.names import named
from rowmill.operators.dedup import dedup
from rowmill.sinks.scratch import shared_dir, stored

NULL_KEYS = ("drop", "group")


def winners_stream(stream: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None, null_keys: str = "drop") -> DataFrame:
    """Streaming frame of the rows that win their key so far; columns as in ``stream``.

    ``order_by``: columns that decide, ascending with nulls first; all others follow, so ties are
    between equal rows.  ``null_keys``: ``drop`` rows with a null key or ``group`` nulls as one value.
    """
    if null_keys not in NULL_KEYS:
        raise ValueError(f"null_keys must be one of {NULL_KEYS}")
    missing = [c for c in [*keys, *(order_by or ())] if c not in stream.columns]
    if missing or not keys:
        raise ValueError(f"keys not in the stream: {missing or 'none given'}")
    rest = [c for c in dict.fromkeys([*(order_by or ()), *stream.columns]) if c not in set(keys)]
    rows = stream
    if null_keys == "drop":
        rows = rows.na.drop(how="any", subset=list(keys))
    best = F.min(F.struct(F.lit(0).alias("__same"), *[named(c) for c in rest])).alias("__best")
    found = rows.groupBy(*[named(k) for k in keys]).agg(best)
    return found.select(*[named(c) if c in set(keys) else F.col("__best").getField(c).alias(c) for c in stream.columns])


def dedup_stream(stream: DataFrame, keys: Sequence[str], root: str, order_by: Sequence[str] | None = None, null_keys: str = "drop",
                 checkpoint: str | None = None, available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start keeping one row per key of ``stream`` under ``root``; ``available_now`` drains what exists and stops."""
    root = root.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    writer = winners_stream(stream, keys, order_by, null_keys).writeStream.outputMode("update").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint or shared_dir(stream.sparkSession, "stream-checkpoint"))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def winners(spark: SparkSession, root: str, schema: StructType | str, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """The table of winners: of each key the best of its changes.  A key has as many changes as batches improved it."""
    rest = None if order_by is None else [*order_by, *(c for c in _columns(spark, schema) if c not in {*order_by, *keys})]
    changes = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/batch=*")
    return dedup(changes, keys, order_by=rest, null_keys="group")


def compact(spark: SparkSession, root: str, schema: StructType | str, keys: Sequence[str], order_by: Sequence[str] | None = None) -> None:
    """Keep one change a key.  Run it while the stream stands still: it replaces the folders of past batches by one."""
    table = stored(winners(spark, root, schema, keys, order_by), "winners")
    table.write.mode("overwrite").parquet(root.rstrip("/") + "/batch=compacted")
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for entry in fs.listStatus(jvm(root)):
        if entry.getPath().getName() != "batch=compacted":
            fs.delete(entry.getPath(), True)


def _columns(spark: SparkSession, schema: StructType | str) -> list[str]:
    return spark.createDataFrame([], schema).columns

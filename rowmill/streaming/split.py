"""Validate-and-split as a streaming job.

Trimming, routing and row validation are narrow, stateless projections, so
the same expressions run on a streaming DataFrame.  Each micro-batch is split
by ``foreachBatch`` into ``valid`` and ``invalid`` Parquet folders.  A batch is
written once and moved to its own ``batch=<id>`` sub-folders when it is complete, so a batch that
is replayed after a failure replaces its earlier partial output and nothing is left behind: together with
the checkpoint (offsets + commits in the shared folder) the sink is
exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rowmill.functions.text import trim_strings
from rowmill.operators.route import apply_rule_set
from rowmill.operators.validate import VALID, ValidationSpec, annotate
from rowmill.sinks.scratch import shared_dir
from rowmill.sinks.writers import write_sides


def annotate_stream(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    spec: ValidationSpec = ValidationSpec(),
    fmt: str = "parquet",
    rule_set: str | None = "preset_basic",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming frame: trimmed, routed (optional) and annotated rows of ``source``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    df = trim_strings(reader.load(source))
    if rule_set:
        df = apply_rule_set(df, rule_set)
    return annotate(df, spec)


def _write_batch(root: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        side = F.when(F.col(VALID), F.lit("valid")).otherwise(F.lit("invalid"))
        write_sides(batch, side, {name: f"{root}/{name}/batch={batch_id}" for name in ("valid", "invalid")}, root)
    return write


def split_stream(
    annotated: DataFrame,
    out_root: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the split sink; ``available_now`` drains what exists and stops."""
    checkpoint = checkpoint or shared_dir(annotated.sparkSession, "stream-checkpoint")
    writer = annotated.writeStream.foreachBatch(_write_batch(out_root.rstrip("/"))).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

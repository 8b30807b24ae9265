"""End-to-end plan: cleanse -> dedup -> route -> validate -> reports.

Built as one lazy chain.  The deduplicated, routed and validated table is the
fork point for the split outputs and every report, so it is materialised once
-- as Parquet in the shared checkpoint folder, not in executor memory -- which
cuts the lineage: a lost executor costs a re-read of that table, never a
re-run of the dedup shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import PRICE, first_present
from rowmill.functions.text import clean_text, trim_strings
from rowmill.operators.aggregate import avg_of
from rowmill.operators.dedup import dedup, detect_keys
from rowmill.operators.reports import REPORTS, run_reports, segment_state
from rowmill.operators.route import apply_rule_set
from rowmill.operators.validate import ValidationSpec, annotate, split, validation_counts
from rowmill.sinks.scratch import input_bytes, stored

#: Row groups, which aren't cut, are mostly smaller than this: files of so many bytes a core make tasks for all cores.
SPREAD_BYTES = 16 << 20


@dataclass(frozen=True)
class PipelineOptions:
    keys: Sequence[str] | None = None          # None: detect from the schema
    normalize_keys: bool = True                # match keys after lower/blank/punctuation clean-up
    rule_set: str = "preset_basic"
    validation: ValidationSpec = field(default_factory=ValidationSpec)
    reports: Sequence[str] = tuple(REPORTS)
    scale: int | None = None                   # exact decimal sums/averages when set
    materialize: bool = True                   # write the fork point to the shared folder
    one_pass: bool = False                     # all reports from one scan (GROUPING SETS)
    spread: bool = True                        # deal out the rows of few input splits before the key clean-up


def key_normalizer(c):
    return clean_text(c, trim=True, lowercase=True, normalize_spaces=True, strip_punct=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if its files hold less than ``SPREAD_BYTES`` a core.

    The key clean-up is four regular expressions a column; rows that come from one small file would all go
    through them in one task.  Spark cuts larger files for all cores by itself, so they are left as
    they are: no table that matters is shuffled for it, and none is put into as few tasks as there are cores.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    limit = min(SPREAD_BYTES, int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most)))
    if len(df.inputFiles()) >= cores or input_bytes(df) >= limit * cores:
        return df
    return df.repartition(cores)


def prepare(df: DataFrame, opts: PipelineOptions = PipelineOptions()) -> DataFrame:
    """Trim strings, dedup on (normalised) keys, route and annotate -- lazily."""
    cleaned = trim_strings(spread(df) if opts.spread and opts.normalize_keys else df)
    keys = list(opts.keys) if opts.keys else detect_keys(cleaned, required=False)
    deduped = dedup(cleaned, keys, match_on=key_normalizer if opts.normalize_keys else None,
                    on_missing_keys="skip")
    routed = apply_rule_set(deduped, opts.rule_set)
    return annotate(routed, opts.validation)


def run(df: DataFrame, opts: PipelineOptions = PipelineOptions()) -> dict[str, DataFrame]:
    """All pipeline outputs as DataFrames over one materialised fork point."""
    annotated = prepare(df, opts)
    if opts.materialize:
        annotated = stored(annotated, "pipeline")
    valid, invalid = split(annotated)
    out = {"annotated": annotated, "valid": valid, "invalid": invalid, "counts": validation_counts(annotated)}
    out.update(run_reports(valid, opts.reports, scale=opts.scale, one_pass=opts.one_pass))
    out["segment_state"] = segment_state(valid, scale=opts.scale)
    return out


def summary_by_segment(df: DataFrame, opts: PipelineOptions = PipelineOptions()) -> DataFrame:
    """Flagship result: per segment and state, valid rows, average price, invalid rows."""
    annotated = prepare(df, opts)
    price = first_present(annotated, PRICE)
    return annotated.groupBy("segment", "state").agg(
        F.count_if(F.col("is_valid")).alias("valid_rows"),
        F.count_if(~F.col("is_valid")).alias("invalid_rows"),
        avg_of(F.when(F.col("is_valid"), price), opts.scale).alias("avg_valid_price"),
    )

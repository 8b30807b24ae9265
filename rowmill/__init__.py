"""rowmill: batch data preparation as pure DataFrame -> DataFrame functions.

Every operator is a composition of built-in Spark expressions so that Catalyst
can prune columns, push filters into the scan and keep the work inside
whole-stage codegen.  Nothing here creates a SparkSession (except the command
line) or collects rows, except the few functions whose output *is* a small
driver-side report.

Subpackages:

- ``rowmill.sources``    CSV / Parquet scans, globs, upstream-input fallback
- ``rowmill.sinks``      Parquet / CSV / JSON writes, split and per-report outputs, shared scratch folder
- ``rowmill.functions``  column expressions: synonyms, safe coercion, dates, buckets, codes, text clean-up
- ``rowmill.operators``  dedup, routing, aggregates and reports, exact percentile, validation, quality, profile
- ``rowmill.plans``      end-to-end plan, throughput, catalog publishing, test fixtures, registered queries
- ``rowmill.streaming``  the row-wise operators on a Structured Streaming source
- ``rowmill.cli``        ``python -m rowmill <stage>``
"""

__version__ = "0.1.0"

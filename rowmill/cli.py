"""Command line: the stages of the original pipeline as sub-commands.

``python -m rowmill <stage> [options]`` (or ``spark-submit -m``-style with the
package on the path).  Each sub-command maps its flags onto the library
functions; the session comes from ``SparkSession.builder.getOrCreate()`` so
cluster settings passed to ``spark-submit`` apply.  Folder layout under
``--root`` (default ``data``) follows the original: ``raw/usa-real-estate/*.csv``
-> ``processed/cleanse_dedup`` -> ``processed/routed`` ->
``processed/aggregated/<report>`` / ``processed/validated/{valid,invalid}``;
quality reports under ``quality/<unix time>``, throughput under ``metrics``.
"""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rowmill.functions.text import clean_text, normalize_strings, trim_strings
from rowmill.operators.aggregate import aggregate
from rowmill.operators.dedup import dedup, dedup_by_join, detect_keys
from rowmill.operators.limit import SMALL, take_ordered
from rowmill.operators.quality import QualitySpec, parse_thresholds, quality_report, report_to_dict
from rowmill.operators.reports import REPORTS, run_reports
from rowmill.operators.route import RULE_SETS, apply_rule_set
from rowmill.operators.validate import ValidationSpec, annotate, invalid_sample, normalize_zip, validation_counts, zip_changes
from rowmill.plans.publish import DEFAULT_TABLES, publish_tables
from rowmill.plans.throughput import measure
from rowmill.sinks.writers import write_named, write_report, write_split, write_table
from rowmill.sources.files import HEADERS, RAW, read_csv, read_table, upstream_input


def _csv_list(text: str | None) -> list[str]:
    return [c.strip() for c in (text or "").split(",") if c.strip()]


def _bound(text: str) -> float | None:
    return None if text.strip().lower() in ("none", "") else float(text)


def _coalesce(n: int | None) -> int | None:
    return n if n is not None and n > 0 else None


def _limit(df: DataFrame, take: int | None) -> DataFrame:
    """Ordered limit; the few rows of a small one are spread over the session's parallelism (they come in
    one partition, which would make every later stage a single task)."""
    if not take or take <= 0:
        return df
    first = take_ordered(df, take)
    return first.repartition(df.sparkSession.sparkContext.defaultParallelism) if take <= SMALL else first


def _csv_flags(p: argparse.ArgumentParser) -> None:
    p.add_argument("--delimiter", default=",")
    p.add_argument("--no-header", action="store_true")
    p.add_argument("--no-infer-schema", action="store_true")
    p.add_argument("--headers", default="check", choices=HEADERS,
                   help="files whose headers differ: fail, unite by column name, or take columns by position")


def _common(p: argparse.ArgumentParser, write: bool = True) -> None:
    p.add_argument("--input", default=None, help="path, glob or Parquet directory; default: upstream stage output")
    p.add_argument("--root", default="data", help="folder holding raw/, processed/, quality/, metrics/")
    p.add_argument("--take", type=int, default=-1, help="keep the first N rows in a repeatable order; <= 0 keeps all")
    if write:
        p.add_argument("--write-output", action="store_true")
        p.add_argument("--coalesce", type=int, default=-1, help="output files per folder; <= 0 writes in parallel")


def _read(spark: SparkSession, args, stage: str) -> DataFrame:
    src = args.input or upstream_input(args.root, stage, spark)
    opts = {}
    if hasattr(args, "delimiter"):
        opts = dict(header=not args.no_header, infer_schema=not args.no_infer_schema, delimiter=args.delimiter,
                    headers=args.headers)
    return _limit(read_table(spark, src, **opts), args.take)


def cmd_ingest(spark, args) -> dict:
    df = _limit(read_csv(spark, args.input or f"{args.root}/{RAW}", header=not args.no_header,
                         infer_schema=not args.no_infer_schema, delimiter=args.delimiter,
                         headers=args.headers), args.take)
    df.printSchema()
    out = {"rows": df.count(), "sample": [r.asDict() for r in df.limit(5).collect()]}
    print(f"rows: {out['rows']}")
    return out


def cmd_cleanse(spark, args) -> dict:
    df = _limit(read_csv(spark, args.input or f"{args.root}/{RAW}", header=not args.no_header,
                         infer_schema=not args.no_infer_schema, delimiter=args.delimiter,
                         headers=args.headers), args.take)
    if not args.no_trim:
        df = trim_strings(df)
    normalize = args.lowercase or args.normalize_spaces or args.strip_punct
    if normalize and not args.keep_original_values:
        df = normalize_strings(df, args.lowercase, args.normalize_spaces, args.strip_punct,
                               columns=_csv_list(args.columns) or None)
    keys = _csv_list(args.keys) or (detect_keys(df) if args.auto_keys else [])
    if not keys:
        raise SystemExit("--keys is required unless --auto-keys is given")
    if normalize and args.keep_original_values:
        # compare keys after the clean-up, keep every value as it was read
        def match(c):
            return clean_text(c, trim=True, lowercase=args.lowercase, normalize_spaces=args.normalize_spaces,
                              strip_punct=args.strip_punct)
        deduped = dedup(df, keys, match_on=match)
    else:
        deduped = dedup_by_join(df, keys) if args.method == "join" else dedup(df, keys)
    out = {"keys": keys}
    if args.write_output:
        out["paths"] = write_table(deduped, f"{args.root}/processed/cleanse_dedup", coalesce=_coalesce(args.coalesce))
    out["rows"] = deduped.count() if not args.write_output else spark.read.parquet(out["paths"]["parquet"]).count()
    print(json.dumps(out))
    return out


def cmd_route(spark, args) -> dict:
    routed = apply_rule_set(_read(spark, args, "route"), args.rules)
    out = {}
    if args.write_output:
        out["paths"] = write_table(routed, f"{args.root}/processed/routed", coalesce=_coalesce(args.coalesce))
        routed = spark.read.parquet(out["paths"]["parquet"])  # count from what was written, not a recompute
    out["segments"] = {r[0]: r[1] for r in routed.groupBy("segment").count().collect()}
    print(json.dumps(out))
    return out


def cmd_aggregate(spark, args) -> dict:
    df = _read(spark, args, "aggregate")
    base = f"{args.root}/processed/aggregated"
    if args.run_all_presets or args.preset:
        names = list(REPORTS) if args.run_all_presets else [args.preset]
        reports = run_reports(df, names, scale=args.scale)
        out = {"groups": {}}
        if args.write_output:
            out["paths"] = write_named(reports, base, coalesce=_coalesce(args.coalesce))
            reports = {n: spark.read.parquet(p["parquet"]) for n, p in out["paths"].items()}
        for name, rep in reports.items():
            out["groups"][name] = rep.count()
        print(json.dumps(out))
        return out
    if not args.group_by or not args.metrics:
        raise SystemExit("give --group-by and --metrics, or --preset / --run-all-presets")
    grouped = aggregate(df, _csv_list(args.group_by), args.metrics, scale=args.scale)
    out = {}
    if args.write_output:
        out["paths"] = write_table(grouped, base, coalesce=_coalesce(args.coalesce))
        grouped = spark.read.parquet(out["paths"]["parquet"])
    out["groups"] = grouped.count()
    print(json.dumps(out))
    return out


def cmd_validate(spark, args) -> dict:
    df = _read(spark, args, "aggregate")
    out = {}
    if args.zip_normalize and args.zip_col in df.columns:
        out["zip_changed_rows"] = zip_changes(df, args.zip_col, args.zip_len, args.zip_numeric, args.zip_truncate).first()[0]
        df = normalize_zip(df, args.zip_col, args.zip_len, args.zip_numeric, args.zip_truncate)
    spec = ValidationSpec(
        required=tuple(_csv_list(args.required_cols)), range_column="price",
        min_value=None if args.min_price is None else float(args.min_price),
        max_value=None if args.max_price is None else float(args.max_price),
        zip_column=args.zip_col, zip_length=args.zip_len, zip_numeric=args.zip_numeric,
        nonneg=tuple(_csv_list(args.nonneg_cols)), integers=tuple(_csv_list(args.int_cols)),
    )
    ann = annotate(df, spec)
    if args.write_output:
        out["paths"] = write_split(ann, f"{args.root}/processed/validated", coalesce=_coalesce(args.coalesce))
        # counts and the sample come from the written tables: no second pass over the input
        ann = spark.read.parquet(out["paths"]["valid"]["parquet"]).unionByName(
            spark.read.parquet(out["paths"]["invalid"]["parquet"]))
    c = validation_counts(ann).first()
    out.update(total=c["total"], valid=c["valid"], invalid=c["invalid"])
    out["sample_invalid"] = [r.asDict() for r in invalid_sample(ann).collect()]
    print(json.dumps(out, default=str))
    return out


def cmd_quality(spark, args) -> dict:
    df = _read(spark, args, "aggregate")
    spec = QualitySpec(
        required=tuple(_csv_list(args.required_cols)), unique_keys=tuple(_csv_list(args.unique_keys)),
        minimum=parse_thresholds(args.min_spec), maximum=parse_thresholds(args.max_spec),
        max_null_fraction=parse_thresholds(args.max_null_frac),
    )
    report = quality_report(df, spec)
    if args.write_output:
        path = f"{args.root}/quality/{int(time.time())}"
        write_report(report, path)
        report = spark.read.json(f"{path}/json")
    d = report_to_dict(report)
    print(json.dumps(d["summary"]))
    for c in d["checks"]:
        if args.print_all or c["status"] == "fail":
            print(f"- {c['check']}: {c['status']}")
    return d


def cmd_throughput(spark, args) -> dict:
    df = _read(spark, args, "aggregate")
    sizes = [int(s) for s in _csv_list(args.sizes)] or [-1]
    m = measure(spark, df, sizes, _csv_list(args.keys) or None, handoff=args.handoff)
    if args.write_output:
        write_report(m, f"{args.root}/metrics")
    rows = [r.asDict() for r in m.collect()]
    for r in rows:
        print(r)
    return {"metrics": rows}


def cmd_persist(spark, args) -> dict:
    tables = list(DEFAULT_TABLES) if args.refresh_all else _csv_list(args.tables)
    if not tables:
        print("no tables given; use --refresh-all or --tables")
        return {"tables": []}
    written = publish_tables(spark, f"{args.root}/processed", tables, location=args.location)
    print(json.dumps({"tables": written}))
    return {"tables": written}


# --- Fixed values: flag names and defaults follow the original stage scripts.
def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="rowmill", description="Batch data preparation on Spark.")
    sub = parser.add_subparsers(dest="stage", required=True)

    p = sub.add_parser("ingest", help="read one CSV: schema, rows, 5 sample rows")
    _common(p, write=False)
    _csv_flags(p)

    p = sub.add_parser("cleanse", help="trim / normalise strings and keep one row per key")
    _common(p)
    _csv_flags(p)
    p.add_argument("--keys")
    p.add_argument("--auto-keys", action="store_true")
    p.add_argument("--no-trim", action="store_true")
    p.add_argument("--lowercase", action="store_true")
    p.add_argument("--normalize-spaces", action="store_true")
    p.add_argument("--strip-punct", action="store_true")
    p.add_argument("--method", choices=["window", "join"], default="window")
    p.add_argument("--columns", help="normalise only these string columns (default: all)")
    p.add_argument("--keep-original-values", action="store_true",
                   help="apply the clean-up only to compare keys; output keeps the values as read")

    p = sub.add_parser("route", help="derive the segment column by a named rule set")
    _common(p)
    p.add_argument("--rules", default="preset_basic", choices=sorted(RULE_SETS))

    p = sub.add_parser("aggregate", help="group-by metrics or named reports")
    _common(p)
    p.add_argument("--preset", choices=sorted(REPORTS))
    p.add_argument("--run-all-presets", action="store_true")
    p.add_argument("--group-by")
    p.add_argument("--metrics")
    p.add_argument("--scale", type=int, default=None, help="exact decimal sums with this many decimals")

    p = sub.add_parser("validate", help="per-row error codes and the valid / invalid split")
    _common(p)
    p.add_argument("--required-cols", default="street,city,state,zip_code,price")
    p.add_argument("--min-price", type=_bound, default=0.0, help="inclusive lower bound; 'none' disables it")
    p.add_argument("--max-price", type=_bound, default=None, help="inclusive upper bound; 'none' disables it")
    p.add_argument("--zip-col", default="zip_code")
    p.add_argument("--zip-len", type=int, default=5)
    p.add_argument("--zip-normalize", action="store_true")
    p.add_argument("--zip-numeric", action="store_true")
    p.add_argument("--zip-truncate", action="store_true", help="cut codes longer than --zip-len")
    p.add_argument("--nonneg-cols", default="price,house_size,acre_lot")
    p.add_argument("--int-cols", default="bed,bath")

    p = sub.add_parser("quality", help="dataset quality checks in one pass")
    _common(p, write=False)
    p.add_argument("--write-output", action="store_true")
    p.add_argument("--required-cols", default="street,city,state,zip_code,price")
    p.add_argument("--unique-keys", default="street,city,state,zip_code")
    p.add_argument("--min", dest="min_spec", default="price:0,house_size:0,acre_lot:0")
    p.add_argument("--max", dest="max_spec", default="")
    p.add_argument("--max-null-frac", default="status:0.2,brokered_by:0.5")
    p.add_argument("--print-all", action="store_true")

    p = sub.add_parser("throughput", help="records per second per stage")
    _common(p, write=False)
    p.add_argument("--write-output", action="store_true")
    p.add_argument("--sizes", default="-1")
    p.add_argument("--keys")
    p.add_argument("--handoff", choices=["persist", "write"], default="persist",
                   help="stage outputs kept in executors (persist) or written to the shared folder (write)")

    p = sub.add_parser("persist", help="publish Parquet outputs as catalog tables")
    p.add_argument("--root", default="data")
    p.add_argument("--tables", default="")
    p.add_argument("--refresh-all", action="store_true")
    p.add_argument("--location", default=None, help="store the tables under this folder (external tables)")
    return parser


COMMANDS = {
    "ingest": cmd_ingest, "cleanse": cmd_cleanse, "route": cmd_route, "aggregate": cmd_aggregate,
    "validate": cmd_validate, "quality": cmd_quality, "throughput": cmd_throughput, "persist": cmd_persist,
}


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = build_parser().parse_args(argv)
    spark = spark or (
        SparkSession.builder.appName(f"rowmill-{args.stage}")
        .config("spark.ui.enabled", "false")  # no web server from a batch job
        .getOrCreate()
    )
    return COMMANDS[args.stage](spark, args)

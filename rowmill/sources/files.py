"""File scans.

Scans are thin declarations over ``DataFrameReader``: column pruning and
filter pushdown happen in Catalyst once a projection or predicate is added
downstream.  For production data pass an explicit ``schema``; inference costs a
full extra pass over CSV input and can lose information (``02108`` -> 2108).
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType, _parse_datatype_string

from rowmill.functions.names import named
from rowmill.sinks.scratch import hadoop_path

HEADERS = ("check", "by_name", "ignore")


def _found(spark: SparkSession, item: str) -> list[str]:
    """Paths that ``item``, a path or a glob, stands for, sorted; asked of the file system that holds
    it, as Spark does.  Without a scheme in ``item`` the answers have none either."""
    fs, at = hadoop_path(spark, item)
    if fs.exists(at):
        return [item]
    hits = fs.globStatus(at) or []
    bare = at.toUri().getScheme() is None
    return sorted(h.getPath().toUri().getPath() if bare else h.getPath().toString() for h in hits)


def _session(spark: SparkSession | None) -> SparkSession:
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("paths are looked up through a Spark session; start one first")
    return spark


def resolve_paths(inputs: str | Sequence[str], spark: SparkSession | None = None) -> list[str]:
    """Expand paths and globs, on any storage Spark reads, into a list.

    What matches nothing raises ``FileNotFoundError`` instead of handing Spark an
    empty list (which fails with an unclear message).
    """
    spark = _session(spark)
    out: list[str] = []
    for item in [inputs] if isinstance(inputs, str) else inputs:
        hits = _found(spark, item)
        if not hits:
            raise FileNotFoundError(f"input not found: {item}")
        out.extend(hits)
    if not out:
        raise FileNotFoundError("no input paths given")
    return out


def first_existing(candidates: Sequence[str], spark: SparkSession | None = None) -> str:
    """First candidate path or glob that exists (upstream fallback chain)."""
    spark = _session(spark)
    for c in candidates:
        if _found(spark, c):
            return c
    raise FileNotFoundError(f"none of the inputs exist: {list(candidates)}")


def _format_of(spark: SparkSession, paths: Sequence[str]) -> str:
    """CSV, unless a single path is a Parquet file or a folder whose data files aren't CSV."""
    if len(paths) != 1:
        return "csv"
    fs, at = hadoop_path(spark, paths[0])
    if not fs.getFileStatus(at).isDirectory():
        return "parquet" if paths[0].endswith(".parquet") else "csv"
    files = fs.listFiles(at, True)
    while files.hasNext():  # the first data file tells
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return "csv" if ".csv" in name else "parquet"
    return "parquet"


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: bool = True,
    infer_schema: bool = True,
    delimiter: str = ",",
    schema: StructType | str | None = None,
    options: dict[str, str] | None = None,
    headers: str = "check",
) -> DataFrame:
    """CSV scan of one path, a glob or a list of paths read as one table.

    With ``schema`` given, inference is skipped (no extra pass) and the declared
    types are used; with ``infer_schema=False`` every column is a string.
    ``options`` pass through to the reader (``quote``, ``escape``, ``multiLine``,
    ``mode``, ``dateFormat`` ...).

    Files are read by position.  ``headers`` says what happens when a file's header differs from
    the first one's (or from ``schema``): ``check`` makes the scan fail with the file's name,
    ``by_name`` unites the files by column name (:func:`read_csv_by_name`), ``ignore`` takes the
    columns by position, as Spark does by default.
    """
    if headers not in HEADERS:
        raise ValueError(f"headers must be one of {HEADERS}")
    if header and headers == "by_name":
        return read_csv_by_name(spark, paths, infer_schema, delimiter, schema, options)
    return _csv(spark, resolve_paths(paths, spark), header, infer_schema, delimiter, schema,
                {"enforceSchema": str(headers == "ignore").lower(), **(options or {})} if header else options)


def _csv(spark, paths, header, infer_schema, delimiter, schema, options) -> DataFrame:
    reader = spark.read.option("header", str(bool(header)).lower()).option("sep", delimiter)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", str(bool(infer_schema)).lower())
    return reader.csv(list(paths))


def csv_headers(spark: SparkSession, paths: str | Sequence[str], delimiter: str = ",",
                options: dict[str, str] | None = None) -> DataFrame:
    """``(path, header)`` of every file: its first line that isn't blank, as text.

    The lines are looked for where they are: only splits that start a file give a row, and
    of each only the first line leaves its task.  A header must not span lines.
    """
    options = options or {}
    text = spark.read.option("encoding", options.get("encoding", "UTF-8"))
    if "lineSep" in options:
        text = text.option("lineSep", options["lineSep"])
    lines = text.text(resolve_paths(paths, spark)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.regexp_replace("value", "^\ufeff", "").alias("line"), F.monotonically_increasing_id().alias("at"))
    first = lines.where((F.col("start") == 0) & (F.trim("line") != ""))
    if "comment" in options:
        first = first.where(~F.startswith("line", F.lit(options["comment"])))
    # a split is read by one task in the order of its lines.  The least number of a file is a hash aggregate, a row a
    # file; an aggregate that keeps the text would sort all lines of its split.  The files' lines are then picked by
    # number: both scans read the same splits of one listing, so a line has one number in both
    least = first.groupBy("path").agg(F.min("at").alias("at"))
    return first.join(F.broadcast(least), ["path", "at"]).select("path", F.col("line").alias("header"))


def _names(header: str, delimiter: str, options: dict[str, str]) -> tuple[str, ...]:
    row = next(csv.reader([header], delimiter=delimiter, quotechar=options.get("quote") or '"'))
    strip = options.get("ignoreLeadingWhiteSpace", "false").lower() == "true"
    return tuple(c.strip() if strip else c for c in row)


#: Types that inference may give, each with what it widens to; two types meet at the first both reach.
_WIDER = {"void": "int", "int": "bigint", "bigint": "decimal", "decimal": "double", "date": "timestamp"}


def _meet(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds values of both."""
    if a == b:
        return a

    def reached(t: DataType) -> list[str]:
        out = ["decimal" if t.simpleString().startswith("decimal") else t.simpleString()]
        while out[-1] in _WIDER:
            out.append(_WIDER[out[-1]])
        return out

    if "void" in (a.simpleString(), b.simpleString()):
        return b if a.simpleString() == "void" else a
    left, right = reached(a), reached(b)
    common = next((t for t in left if t in right), "string")
    return _parse_datatype_string("double" if common == "decimal" else common)


def read_csv_by_name(
    spark: SparkSession,
    paths: str | Sequence[str],
    infer_schema: bool = True,
    delimiter: str = ",",
    schema: StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """CSV files whose headers differ in order or in columns, as one table by column name.

    Files are grouped by header; every group is one scan in its own column order, so a column
    keeps its values wherever it stands.  A column that a file lacks is null in its rows.  The
    result has the columns of ``schema``, or else all columns of all files, those of the header
    that most files have first (of equally many, the first in text order), others as they
    come.  Without ``schema`` a column gets the narrowest type that holds what
    inference finds in every group (text beside numbers is text, as it stands in the file).
    Files without a line give no rows.  A name twice in one header is an error.
    """
    options = dict(options or {})
    found = resolve_paths(paths, spark)
    rows = csv_headers(spark, found, delimiter, options).groupBy("header").agg(
        F.sort_array(F.collect_list("path")).alias("paths")).collect()  # the files' names, as a listing has
    if isinstance(schema, str):
        schema = _parse_datatype_string(schema)
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(rows, key=lambda r: (-len(r["paths"]), r["header"])):
        groups.setdefault(_names(r["header"], delimiter, options), []).extend(r["paths"])
    for names in groups:
        if len(set(names)) < len(names):
            raise ValueError(f"a column name occurs twice in {names} ({groups[names][0]})")
    if not groups:
        return spark.createDataFrame([], schema or StructType([]))
    options = {**options, "enforceSchema": "false"}
    order = list(schema.names) if schema is not None else list(dict.fromkeys(c for names in groups for c in names))
    types: dict[str, DataType] = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    if schema is None:
        for names, files in groups.items():
            own = _csv(spark, files, True, infer_schema, delimiter, None, options).schema
            for name, field in zip(names, own.fields):
                types[name] = _meet(types[name], field.dataType) if name in types else field.dataType
    text = _parse_datatype_string("string")
    parts = []
    for names, files in groups.items():
        own = StructType([StructField(c, types.get(c, text)) for c in names])
        part = _csv(spark, files, True, False, delimiter, own, options)
        parts.append(part.select(*[named(c) if c in names else F.lit(None).cast(types[c]).alias(c) for c in order]))
    return reduce(DataFrame.unionByName, parts)


def read_parquet(spark: SparkSession, paths: str | Sequence[str], row_id: str | None = None) -> DataFrame:
    """Parquet scan of one directory/file or several; ``row_id`` names a column that numbers the rows
    (see :func:`with_row_id`)."""
    scan = spark.read.parquet(*resolve_paths(paths, spark))
    return with_row_id(scan, row_id) if row_id else scan


#: So many files' row counts (about 200 bytes each) are broadcast; beyond that Spark chooses the join.
FILES_BROADCAST = 100_000


def with_row_id(scan: DataFrame, name: str = "row_id") -> DataFrame:
    """Numbers the rows of a plain Parquet scan from 0, by file path and place in the file.

    The reader tells each row's file and place, so the number doesn't depend on how files are
    split into tasks, on retries or on later shuffles: the same files give the same ids.  A file
    starts where the rows of all files before it end; these counts come from the file footers
    alone.  ``scan`` must read files directly, without a filter: ids are contiguous over
    what it reads.
    """
    if name in scan.columns:
        raise ValueError(f"the table has a column {name!r} already")
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    per_file = scan.select(path.alias("__file")).groupBy("__file").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    starts = per_file.select("__file", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    if len(scan.inputFiles()) <= FILES_BROADCAST:
        starts = F.broadcast(starts)
    rows = scan.select("*", path.alias("__file"), place.alias("__place"))
    both = rows.join(starts, "__file")
    return both.select(*[named(c) for c in scan.columns], (F.col("__start") + F.col("__place")).alias(name))


def read_table(
    spark: SparkSession,
    inputs: str | Sequence[str],
    format: str | None = None,
    **csv_options,
) -> DataFrame:
    """Read a table; without ``format``, one folder of Parquet files is Parquet, all else CSV."""
    paths = resolve_paths(inputs, spark)
    if format is None:
        format = _format_of(spark, paths)
    if format == "parquet":
        return spark.read.parquet(*paths)
    if format == "csv":
        return read_csv(spark, paths, **csv_options)
    return spark.read.format(format).load(paths)


# --- Fixed values: stage hand-off folders under a project root, newest stage first.
RAW = "raw/usa-real-estate/*.csv"
UPSTREAM = {
    "route": ("processed/cleanse_dedup/parquet", RAW),
    "aggregate": ("processed/routed/parquet", "processed/cleanse_dedup/parquet", RAW),
}


def upstream_input(root: str, stage: str = "aggregate", spark: SparkSession | None = None) -> str:
    """The newest existing hand-off for ``stage`` under ``root`` (routed -> dedup -> raw CSV)."""
    chain = UPSTREAM.get(stage, UPSTREAM["aggregate"])
    return first_existing([f"{root.rstrip('/')}/{rel}" for rel in chain], spark)

"""Writers.

Outputs are written in parallel by default (one file per partition); a single
output file means a single writer task, so ``coalesce`` is opt-in for small
results only.  CSV cannot hold arrays, so array columns are joined with ``|``
on the CSV path while Parquet keeps them typed.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from rowmill.functions.names import named
from rowmill.operators.validate import VALID
from rowmill.sinks.scratch import discard, hadoop_path, stored

ARRAY_SEPARATOR = "|"


def csv_safe(df: DataFrame, separator: str = ARRAY_SEPARATOR) -> DataFrame:
    """Make a frame writable as CSV: arrays joined, structs/maps as JSON text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, ArrayType):
            cols.append(F.concat_ws(separator, named(f.name).cast("array<string>")).alias(f.name))
        elif isinstance(f.dataType, (StructType, MapType)):
            cols.append(F.to_json(named(f.name)).alias(f.name))
        else:
            cols.append(named(f.name))
    return df.select(*cols)


def write_table(
    df: DataFrame,
    root: str,
    formats: Sequence[str] = ("parquet", "csv"),
    coalesce: int | None = None,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    rebalance: bool = True,
    compression: str | None = None,
    target_bytes: int | None = None,
    sort_by: Sequence[str] = (),
) -> dict[str, str]:
    """Write ``df`` under ``root/<format>`` for each format; returns the paths.

    With ``target_bytes`` the Parquet files are of that size, sorted by ``sort_by`` (:func:`write_sized`).

    The plan of ``df`` runs once: Parquet is written first and the other formats are
    written from it (from a scratch copy if Parquet isn't asked for), so all
    formats hold the same rows.

    With ``partition_by`` the rows are first rebalanced by the partition columns
    (``rebalance`` hint): without it every task writes a file into every value it
    sees (tasks x values small files); with a plain ``repartition`` a value that
    holds a third of the rows would be written by one task.  The hint lets AQE
    split such a value into advisory-size pieces and merge small ones (with AQE
    off the hint is a plain hash repartition by the partition columns).
    """
    if len(formats) > 1 and "parquet" not in formats:
        df = stored(df, "formats")
    out = df
    if partition_by and rebalance and not (coalesce and coalesce > 0):
        out = out.hint("rebalance", *partition_by)
    out = out.coalesce(coalesce) if coalesce and coalesce > 0 else out
    paths: dict[str, str] = {}
    for fmt in sorted(formats, key=lambda f: f != "parquet"):
        target = f"{root.rstrip('/')}/{fmt}"
        if fmt == "parquet" and target_bytes:
            if partition_by or mode != "overwrite":
                raise ValueError("target_bytes takes neither partition_by nor a mode")
            write_sized(df, target, target_bytes, sort_by, compression)
            paths[fmt] = target
            out = df.sparkSession.read.schema(df.schema).parquet(target)
            continue
        frame = csv_safe(out) if fmt == "csv" else out
        writer = frame.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if fmt == "csv":
            writer = writer.option("header", "true")
        if compression:
            writer = writer.option("compression", compression)
        writer.format(fmt).save(target)
        paths[fmt] = target
        if fmt == "parquet":  # columns in their order and with their types, also those of the folders
            out = df.sparkSession.read.schema(df.schema).parquet(target).select(*[named(c) for c in df.columns])
            if partition_by and rebalance and not (coalesce and coalesce > 0):
                out = out.hint("rebalance", *partition_by)
            out = out.coalesce(coalesce) if coalesce and coalesce > 0 else out
    return {fmt: paths[fmt] for fmt in formats}


def write_sized(df: DataFrame, path: str, target_bytes: int, sort_by: Sequence[str] = (), compression: str | None = None) -> int:
    """Write ``df`` as Parquet files of about ``target_bytes`` each; returns their number.

    Rows are sorted by ``sort_by`` across files and inside them, so that files and row groups hold ranges
    that filters can skip; a tie-breaker cuts a value that many rows share into several files.  How
    many files it takes is measured, not guessed: the plan's rows are stored once, their bytes give a
    first number of ranges, and if the sorted files come out more than a quarter off (sorting
    compresses better), they are cut anew by what they take.  The files replace what was at ``path``
    only when they are complete.
    """
    if target_bytes <= 0:
        raise ValueError("target_bytes must be positive")
    spark = df.sparkSession
    held = stored(df, "sized")
    fs, at = hadoop_path(spark, path)
    total = sum(hadoop_path(spark, f)[0].getFileStatus(hadoop_path(spark, f)[1]).getLen() for f in held.inputFiles())
    order = [named(c).asc_nulls_first() for c in sort_by]
    staged = f"{path.rstrip('/')}.sized-{uuid.uuid4().hex}"
    _, folder = hadoop_path(spark, staged)
    try:
        for turn in range(3):
            files = max(1, round(total / target_bytes))
            keyed = held.withColumn(_TIE, F.monotonically_increasing_id())
            ranged = keyed.repartitionByRange(files, *order, F.col(_TIE)).sortWithinPartitions(*order, _TIE).drop(_TIE)
            writer = ranged.write.mode("overwrite")
            (writer.option("compression", compression) if compression else writer).parquet(staged)
            total = fs.getContentSummary(folder).getLength()
            if 0.75 <= total / files / target_bytes <= 1.25 or files == max(1, round(total / target_bytes)):
                break
        fs.mkdirs(at.getParent())
        fs.delete(at, True)
        if not fs.rename(folder, at):
            raise OSError(f"{folder} can't be moved to {at}")
        return files
    finally:
        fs.delete(folder, True)
        discard(held)


_TIE = "__rowmill_tie"


def write_split(
    annotated: DataFrame,
    root: str,
    formats: Sequence[str] = ("parquet", "csv"),
    coalesce: int | None = None,
) -> dict[str, dict[str, str]]:
    """Valid and invalid records of an annotated table under ``root/valid`` and ``root/invalid``.

    The plan runs once and its rows are written once: one Parquet write, partitioned by validity, whose two
    folders become the two tables.  Other formats are written likewise from the Parquet tables
    (from a scratch copy if Parquet isn't asked for).  Old tables are replaced when the new ones
    are complete; a write that fails leaves them as they are.
    """
    side = F.when(named(VALID), F.lit("valid")).otherwise(F.lit("invalid"))
    root = root.rstrip("/")
    if len(formats) > 1 and "parquet" not in formats:
        annotated = stored(annotated, "split")
    paths: dict[str, dict[str, str]] = {"valid": {}, "invalid": {}}
    source = annotated
    for fmt in sorted(formats, key=lambda f: f != "parquet"):
        targets = {name: f"{root}/{name}/{fmt}" for name in paths}
        write_sides(source, side, targets, root, fmt, coalesce)
        for name, target in targets.items():
            paths[name][fmt] = target
        if fmt == "parquet":
            source = annotated.sparkSession.read.schema(annotated.schema).parquet(*targets.values())
    return {name: {fmt: own[fmt] for fmt in formats} for name, own in paths.items()}


_SIDE = "__rowmill_side"


def write_sides(df: DataFrame, side: Column, targets: Mapping[str, str], root: str, fmt: str = "parquet",
                coalesce: int | None = None) -> None:
    """Write ``df`` once, partitioned by the text ``side``, and make the folder of each value the table
    ``targets[value]``; a value without rows gets an empty table with the same columns.

    The write goes to a folder of its own under ``root``.  Only when it is complete are old targets
    replaced, by moves inside one file system (where moves copy, as in object stores, they cost a
    copy of the output).
    """
    spark = df.sparkSession
    staged = f"{root}/.split-{uuid.uuid4().hex}"
    out = df.coalesce(coalesce) if coalesce and coalesce > 0 else df
    columns = csv_safe(out) if fmt == "csv" else out
    fs, folder = hadoop_path(spark, staged)
    try:
        _writer(columns.withColumn(_SIDE, side), fmt).partitionBy(_SIDE).save(staged)
        for name, target in targets.items():
            _, own = hadoop_path(spark, f"{staged}/{_SIDE}={name}")
            if not fs.exists(own):
                _writer(spark.createDataFrame([], columns.schema), fmt).save(f"{staged}/{_SIDE}={name}")
            _, at = hadoop_path(spark, target)
            fs.mkdirs(at.getParent())
            fs.delete(at, True)
            if not fs.rename(own, at):
                raise OSError(f"{own} can't be moved to {at}")
    finally:
        fs.delete(folder, True)


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    return df.write.format(fmt).option("header", "true") if fmt == "csv" else df.write.format(fmt)


def write_named(
    frames: Mapping[str, DataFrame],
    root: str,
    formats: Sequence[str] = ("parquet", "csv"),
    coalesce: int | None = None,
) -> dict[str, dict[str, str]]:
    """One sub-folder per named frame (reports)."""
    return {name: write_table(df, f"{root.rstrip('/')}/{name}", formats, coalesce) for name, df in frames.items()}


def write_report(report: DataFrame, root: str, formats: Sequence[str] = ("json", "csv")) -> dict[str, str]:
    """A small report table (quality checks, throughput records) as one JSON and one CSV file."""
    return write_table(report, root, formats=formats, coalesce=1)

"""Publish Parquet outputs as named SQL tables of the session catalog.

A published name is a view over the newest of its versions, each a table of its own with its own
folder.  A refresh writes a new version first and then lets the view point to it, which is one change
of the catalog: readers that planned before it go on with the old version, those after it get the new
one, none meets a table in between.  A write that fails leaves the view and its versions as they
were.  Versions older than the last ``keep`` go with their files.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from rowmill.sinks.scratch import hadoop_path

# --- Fixed values: pipeline outputs that can be published, relative to an output root.
DEFAULT_TABLES = {
    "routed": "routed/parquet",
    "market_trends": "aggregated/market_trends/parquet",
    "property_type_size": "aggregated/property_type_size/parquet",
    "lot_size_influence": "aggregated/lot_size_influence/parquet",
    "broker_performance": "aggregated/broker_performance/parquet",
    "status_analysis": "aggregated/status_analysis/parquet",
    "time_yearly": "aggregated/time_yearly/parquet",
}


def publish_tables(
    spark: SparkSession,
    root: str,
    tables: Iterable[str] | None = None,
    known: Mapping[str, str] = DEFAULT_TABLES,
    location: str | None = None,
    prefix: str = "",
    buckets: Mapping[str, tuple[int, Sequence[str]]] | None = None,
    keep: int = 2,
) -> list[str]:
    """Create or refresh one table per name from ``root/<relative path>`` (see :func:`publish_version`).

    Unknown names are skipped with a message; all known tables when ``tables``
    is None.  With ``location`` the tables are external, stored under it.
    ``buckets`` maps a name to ``(number of buckets, columns)``: see
    :func:`save_table`.  Returns the names of the tables written.
    """
    written: list[str] = []
    for name in (list(tables) if tables is not None else list(known)):
        if name not in known:
            print(f"skipping unknown table {name!r}; known: {sorted(known)}")
            continue
        df = spark.read.parquet(f"{root.rstrip('/')}/{known[name]}")
        bucket = (buckets or {}).get(name)
        written.append(publish_version(df, prefix + name, None if location is None else f"{location.rstrip('/')}/{name}",
                                       bucket_by=bucket, keep=keep))
    return written


def versions(spark: SparkSession, name: str) -> list[str]:
    """The version tables of a published name, oldest first."""
    db, _, own = name.rpartition(".")
    found = spark.catalog.listTables(*([db] if db else []))
    pattern = re.compile(re.escape(own) + r"__v(\d+)_[0-9a-f]{8}", re.I)
    numbers = sorted((int(m[1]), t.name) for t in found if t.tableType != "VIEW" and (m := pattern.fullmatch(t.name)))
    return [f"{db}.{t}" if db else t for _, t in numbers]


def publish_version(df: DataFrame, name: str, location: str | None = None,
                    bucket_by: tuple[int, Sequence[str]] | None = None, keep: int = 2) -> str:
    """Write ``df`` as the next version of ``name`` and let the view ``name`` point to it.

    With ``location`` every version is an external table in a folder of its own under it.  A plain
    table of that name, from an earlier way of publishing, gives way to the view.  Returns ``name``.
    """
    if keep < 1:
        raise ValueError("at least the published version must be kept")
    spark = df.sparkSession
    before = versions(spark, name)
    number = int(before[-1].rpartition("__v")[2].split("_")[0]) + 1 if before else 1
    # a name of its own: another publisher, or files of a catalog that is gone, are never met
    version = f"{name}__v{number:06d}_{uuid.uuid4().hex[:8]}"
    path = _folder(location, version)
    try:
        save_table(df, version, path, bucket_by, mode="errorifexists")
    except Exception:
        _remove(spark, version, path)
        raise
    if any(t.name.lower() == name.rpartition(".")[2].lower() and t.tableType not in ("VIEW", "TEMPORARY")
           for t in spark.catalog.listTables(*([name.rpartition(".")[0]] if "." in name else []))):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in [*before, version][:-keep]:
        _remove(spark, old, _folder(location, old))
    return name


def _folder(location: str | None, version: str) -> str | None:
    return None if location is None else f"{location.rstrip('/')}/v{version.rpartition('__v')[2]}"


def _remove(spark: SparkSession, table: str, path: str | None) -> None:
    """Drop a version table; the files of an external one go too."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    if path is not None:
        fs, at = hadoop_path(spark, path)
        fs.delete(at, True)


def save_table(df: DataFrame, name: str, location: str | None = None,
               bucket_by: tuple[int, Sequence[str]] | None = None, mode: str = "overwrite") -> str:
    """``saveAsTable``, optionally bucketed and sorted by key columns.

    A table bucketed by the keys that later dedups, uniqueness checks or joins
    use is already hash-partitioned on them: those plans read it without an
    exchange, so the shuffle is paid once at write time instead of per query.
    """
    if bucket_by:
        # one task per bucket: without it every task would write a file into every bucket it meets
        df = df.repartition(int(bucket_by[0]), *bucket_by[1])
    writer = df.write.mode(mode).format("parquet")
    if location:
        writer = writer.option("path", location)
    if bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(int(n), *cols).sortBy(*cols)
    writer.saveAsTable(name)
    return name

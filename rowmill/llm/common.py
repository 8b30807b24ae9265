"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import rowmill
from rowmill.sinks.scratch import ensure_checkpoint_dir, shared_dir

_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once a session, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(rowmill.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="rowmill-code-"), "rowmill.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under its own names (extra columns, whatever
    they are called, never meet the operator's)."""
    ship_code(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str, str]:
    """``docs`` with its columns named x0, x1, ..., and the new names of the id and the text.  No name that
    a caller may have chosen meets an operator's own then; ``toDF(*docs.columns)`` restores them."""
    ship_code(docs.sparkSession)
    names = [f"x{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder; the lineage is cut, so a
    lost executor costs no recomputation.  Spark removes the files with the last reference."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`saved`, but as Parquet: compressed and column-wise, for wide rows."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    gone_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def gone_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove ``path`` when the driver ends."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)


def parts(spark: SparkSession) -> int:
    """Number of reduce partitions: the session's, at least 2."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def some_rows(df: DataFrame, size: int, key: Column) -> DataFrame:
    """At most ``size`` rows, those of the smallest hashes ``key``.  Of a large table only so large a share
    of the hashes is looked at that about a quarter more rows, and a hundred, leave all tasks together."""
    n, some = df.count(), 1.25 * size + 100
    own = df.withColumn("__key", key)
    if n > some:
        own = own.where(F.pmod("__key", F.lit(1 << 40)) < int((1 << 40) * some / n))
    return own.orderBy("__key").limit(size).drop("__key")


def put_shared(spark: SparkSession, data: bytes, name: str) -> str:
    """Write ``data`` as one file in the shared folder, hand it to every executor with
    ``addFile`` and return the name under which ``SparkFiles.get`` finds it."""
    jvm, sc = spark._jvm, spark.sparkContext
    file = f"{name}-{uuid.uuid4().hex}.bin"
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark, 'files')}/{file}")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    try:
        step = 1 << 20
        for at in range(0, len(data), step):
            out.write(bytearray(data[at : at + step]))
    finally:
        out.close()
    gone_at_exit(spark, path.toString())
    sc.addFile(path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return file


def binary(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty; nothing is decoded."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """Text of a string column, null as empty."""
    return [x or "" for x in column.to_pylist()]

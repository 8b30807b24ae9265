"""Shared scratch folder for intermediate tables.

On a cluster the folder must be visible to every executor and survive the loss
of any of them, so it is taken from ``spark.checkpoint.dir`` (the shared folder
the cluster names).  Only a local session without that setting gets a folder of
its own; anywhere else the missing setting is an error.

All scratch paths of a session lie under one folder, which the file system
removes when the driver ends.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def _configured(spark: SparkSession) -> str | None:
    value = spark.conf.get(_CONF, None)
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get(_CONF)
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        return None


def _root(spark: SparkSession) -> str:
    root = _configured(spark)
    if root:
        return root
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {_CONF} to a folder that the driver and all executors share (master is {master})")
    root = tempfile.mkdtemp(prefix="rowmill-checkpoint-")
    spark.conf.set(_CONF, root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any path or URI that Spark can read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def shared_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique path under the session's shared scratch folder (not yet created)."""
    base = f"{_root(spark).rstrip('/')}/rowmill-{spark.sparkContext.applicationId}"
    fs, at = hadoop_path(spark, base)
    if not fs.exists(at):
        fs.mkdirs(at)
        fs.deleteOnExit(at)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "scratch") -> DataFrame:
    """``df`` computed once, as Parquet in the shared scratch folder, and read back: everything after
    it reads the same rows, however its plan differs, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, each counted once."""
    total = 0
    for f in df.inputFiles():
        fs, at = hadoop_path(df.sparkSession, f)
        total += fs.getFileStatus(at).getLen()
    return total


def discard(df: DataFrame) -> None:
    """Remove the files behind a frame read from a stored table, before the driver ends; it must not be read again."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        fs, at = hadoop_path(spark, folder)
        fs.delete(at, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable: the context's checkpoint folder is the
    shared one from ``spark.checkpoint.dir`` (a local folder only when that is unset)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(_root(spark))
    return sc.getCheckpointDir()

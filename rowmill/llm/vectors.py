"""What the two vector searches share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.common import ship_code


def width(emb: DataFrame) -> int:
    """Length of the longest vector; shorter ones count as padded with zeros."""
    return int(emb.agg(F.max(F.size("embedding"))).first()[0] or 0)


def usable(emb: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>) of rows with an id and a vector of finite components."""
    ship_code(emb.sparkSession)
    own = emb.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return own.where("vec_id is not null and embedding is not null").where(~bad)


def packed(own: DataFrame, wide: int, kind: str, scale: int | None = None) -> DataFrame:
    """(vec_id, v): the vector as bytes of numpy type ``kind``; with ``scale``, floor(scale * x), held within 2^62."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            size = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
            x = np.zeros((len(column), wide))
            x[np.arange(wide) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
            x = np.floor(np.clip(x * scale, -(2.0**62), 2.0**62)) if scale else x + 0.0  # -0.0 becomes 0.0
            raw = x.astype(kind).tobytes()
            step = wide * np.dtype(kind).itemsize
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([raw[k * step : (k + 1) * step] for k in range(len(column))], pa.binary())], ["vec_id", "v"])

    return own.mapInArrow(run, "vec_id long, v binary")


def distinct(vectors: DataFrame, ids: int) -> DataFrame:
    """(v, ids): each different vector with its ``ids`` smallest different vec_ids, ascending.  Rows repeated
    whole are one before ids are ranked; only so many rows of a vector leave a task, however often it occurs."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = vectors.distinct().withColumn("__r", rank).where(F.col("__r") <= ids)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def matrix(column: pa.Array | pa.ChunkedArray, kind: str, wide: int) -> np.ndarray:
    """Rows of packed vectors."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, wide) if wide else np.zeros((len(column), 0), kind)


def unpack(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return np.append(0, np.cumsum(lengths)), column.flatten().to_numpy(zero_copy_only=False)

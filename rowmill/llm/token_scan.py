"""Token counts of documents in flat, unindexed token files, by a scan for separators.

A token file is nothing but little-endian unsigned 16-bit ids; every document ends with the
end-of-document id, and may start with a header of its doc_id in five 15-bit digits.  A file
is searched block by block with vectorised comparisons.  A document that crosses blocks is
stitched by a prefix scan over the blocks' summaries: running sums of separators, the
running last separator and the header that is open there.

Spark writes the files itself (the text sink with the end-of-document id as line
separator) and lists and reads them with its binary source, so any shared storage works.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowmill.llm.bpe import few
from rowmill.llm.common import gone_at_exit, id_text, saved, shared_dir, strings
from rowmill.llm.packing import default_ranks, encoding

END = 50256
HEADER = 5
BLOCK = 1 << 19
NO_ID = -(1 << 63)


def header(doc_id: int | None) -> bytes:
    """Five digits of base 2^15, so that none is the end id; a null id is written as the smallest long.
    Bits past the 75th don't exist: longs need 64."""
    x = (NO_ID if doc_id is None else doc_id) + (1 << 63)
    return np.array([x >> (15 * k) & 0x7FFF for k in range(HEADER)], "<u2").tobytes()


def read_headers(digits: np.ndarray) -> np.ndarray:
    """doc_ids of rows of five digits."""
    x = np.zeros(len(digits), np.uint64)
    for k in range(HEADER):
        x |= digits[:, k].astype(np.uint64) << np.uint64(15 * k)
    return (x ^ np.uint64(1 << 63)).view(np.int64)


def write_tokens(docs: DataFrame, path: str, ranks_path: str | None = None) -> None:
    """Token files of all documents under ``path``.  The text of special tokens is ordinary text, so the
    end id stands only between documents."""
    with open(ranks_path or default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if len(ranks) != END:
        raise ValueError(f"the end id {END} must be the first id after the vocabulary of {len(ranks)}")
    shared = docs.sparkSession.sparkContext.broadcast((ranks, {"<|endoftext|>": END}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(*shared.value)
        for batch in few(batches):
            rows = [header(d) + own.encode(t, False).astype("<u2").tobytes() for d, t in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    end = np.array([END], "<u2").tobytes().decode("latin-1")
    out = id_text(docs).mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    out.write.option("encoding", "ISO-8859-1").option("lineSep", end).text(path)


def scan_block(ids: np.ndarray, at: int, size: int, digits: int) -> tuple[np.ndarray, np.ndarray, int | None]:
    """Of the block ids[at : at + size]: separators, ids of the documents that start after each, and
    the id of the one that starts with the file (at 0).  Headers may reach into the next block."""
    ends = at + np.flatnonzero(ids[at : at + size] == END)
    if not digits:
        return ends, np.full(len(ends), NO_ID), NO_ID if at == 0 else None
    starts = np.append(ends + 1, 0) if at == 0 else ends + 1
    whole = starts + digits <= len(ids)
    found = np.full(len(starts), NO_ID)
    if whole.any():
        found[whole] = read_headers(ids[starts[whole][:, None] + np.arange(digits)])
    return (ends, found[:-1], int(found[-1])) if at == 0 else (ends, found, None)


def count_tokens(spark: SparkSession, path: str, digits: int = HEADER, block: int = BLOCK) -> DataFrame:
    """(doc_id, file, number, n_tokens) of every document that is ended, headers not counted; ``number``
    counts from 0 in each file.  Without headers (``digits`` 0) doc_id is null.  An odd last byte and
    tokens after the last end id belong to no document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "block", "kind", "k", "doc_id", "n", "end"]
        for batch in batches:
            for i in range(batch.num_rows):
                file, content = batch.column("file")[i].as_py(), batch.column("content")[i].as_buffer()
                ids = np.frombuffer(content, "<u2", len(content) // 2)
                for b, at in enumerate(range(0, len(ids), block)):
                    ends, own, opened = scan_block(ids, at, block, digits)
                    n = len(ends)
                    # documents that start and end inside: kind 0; the first end: kind 1; the block: kind 2
                    doc = np.array([*own[: max(0, n - 1)], *[NO_ID][: n > 0], own[-1] if n else NO_ID if opened is None else opened], np.int64)
                    kind = np.array([0] * max(0, n - 1) + [1] * (n > 0) + [2], np.int32)
                    k = np.array([*range(1, n), *[0][: n > 0], n], np.int64)
                    size = np.array([*(np.diff(ends) - 1 - digits), *[0][: n > 0], n], np.int64)
                    end = np.array([*ends[1:], *ends[:1], ends[-1] if n else -1], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(doc)), pa.array(np.full(len(doc), b, np.int64)), pa.array(kind), pa.array(k), pa.array(doc), pa.array(size), pa.array(end)], names)
                    if b == 0 and n:  # the file's own first document, open before the first block
                        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([-1], pa.int64()), pa.array([2], pa.int32()), pa.array([0], pa.int64()), pa.array([opened], pa.int64()), pa.array([0], pa.int64()), pa.array([-1], pa.int64())], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = saved(files.select(F.col("path").alias("file"), "content").mapInArrow(run, "file string, block long, kind int, k long, doc_id long, n long, end long"))
    scan = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # a block that ends nothing leaves the document open that was
    opens = F.when((F.col("n") > 0) | (F.col("block") == -1) | ((F.col("block") == 0) & (F.col("end") < 0)), F.col("doc_id"))
    summary = found.where("kind = 2").select("file", "block", F.coalesce(F.sum("n").over(scan), F.lit(0)).alias("before"), F.max("end").over(scan).alias("last"), F.last(opens, ignorenulls=True).over(scan).alias("open"))
    first = found.where("kind = 1").drop("doc_id", "n").join(summary, ["file", "block"])
    first = first.select("file", F.col("open").alias("doc_id"), F.col("before").alias("number"), (F.col("end") - F.coalesce("last", F.lit(-1)) - 1 - digits).alias("n_tokens"))
    inner = found.where("kind = 0").join(summary.select("file", "block", "before"), ["file", "block"])
    inner = inner.select("file", "doc_id", (F.col("before") + F.col("k")).alias("number"), F.col("n").alias("n_tokens"))
    return inner.unionByName(first).select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "file", "number", "n_tokens")


def document_tokens(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every document, counted in token files that are written first.

    Null and empty texts have 0 tokens; a null id stays null (the smallest long is taken for one);
    repeated rows are documents of their own; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = shared_dir(spark, "tokens")
    write_tokens(docs, path, ranks_path)
    gone_at_exit(spark, path)
    return count_tokens(spark, path).select("doc_id", "n_tokens")

"""Line deduplication that returns keep bitmaps instead of text.

1. Every document gives (key hash, document, position) for its lines that count.
2. These rows are dealt out by ranges of (hash, document descending) and sorted by
   hash, document (largest first) and position.  Ranges cut inside a hash too, so a line that
   a third of all documents hold is the work of many tasks.
3. Each task streams its rows.  Of a hash that lies whole inside the range, the lines
   of its first document stay and those of the later ones go, if there are enough documents.
   The hashes at a range's two ends give rows to settle and one row of counts; the
   counts, two rows a task, are added up by hash.
4. Dropped positions are gathered by document into a compressed keep bitmap.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.bpe import few
from rowmill.llm.common import binary, id_text, numbered, parts, written

MIN_CHARS = 20
MIN_DOCS = 3
LINES = "h1 long, h2 long, doc long, mark long, pos int"


def line_key(line: bytes) -> bytes:
    """White space of ASCII stripped at both ends, A-Z lower-cased (what ``bytes`` methods do)."""
    return line.strip().lower()


def counts(key: bytes, min_chars: int) -> bool:
    """At least ``min_chars`` code points."""
    return len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars)


def text_mark(text: bytes) -> int:
    """Tells rows of one doc_id with different texts apart."""
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def with_keys(docs: DataFrame) -> DataFrame:
    """(doc, text): a null id counts as one document, smaller than all others."""
    return docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), "text")


def lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc, mark, pos) of every line whose key counts; h1, h2 are a 128-bit hash of it."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            digests, doc, mark, pos = [], [], [], []
            for d, text in zip(batch.column("doc").to_pylist(), binary(batch.column("text"))):
                if len(text) < min_chars:
                    continue
                at = len(pos)
                for k, line in enumerate(text.split(b"\n")):
                    if len(line) >= min_chars and counts(key := line.strip().lower(), min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        pos.append(k)
                if n := len(pos) - at:
                    doc += [d] * n
                    mark += [text_mark(text)] * n
            h = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype("i8")
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(doc, pa.int64()), pa.array(mark, pa.int64()), pa.array(pos, pa.int32())], ["h1", "h2", "doc", "mark", "pos"])

    return docs.mapInArrow(split, LINES)


def stream(sorted_lines: DataFrame, min_docs: int) -> DataFrame:
    """Decide inside each sorted range.  Rows: kind 0, a line to drop; kind 1, a line whose hash reaches
    an end of the range (doc and first document in it); kind 2, such a hash's number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "h1", "h2", "doc", "mark", "pos", "n"]

        def rows(kind: int, h1, h2, doc, mark, pos, n) -> pa.RecordBatch:
            size = len(doc)
            return pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, "i4")), pa.array(h1), pa.array(h2), pa.array(doc), pa.array(mark), pa.array(pos), pa.array(n)], names)

        def totals(h1: int, h2: int, first: int, n: int) -> pa.RecordBatch:
            return rows(2, np.array([h1]), np.array([h2]), np.array([first]), np.zeros(1, "i8"), np.zeros(1, "i4"), np.array([n], "i8"))

        # `first`: the range's first hash, whose beginning may lie in an earlier range.
        # `open`: the hash at the end of what was read; it may go on in the next batch or range.
        first: tuple[int, int] | None = None
        open_hash: tuple[int, int] | None = None
        open_first = open_last = 0
        open_docs = 0
        held: list[tuple[np.ndarray, ...]] = []  # of the open hash, while it has too few documents to decide

        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, doc, mark, pos = (batch.column(c).to_numpy() for c in ("h1", "h2", "doc", "mark", "pos"))
            new = np.ones(len(doc), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(doc))
            step = new.copy()
            step[1:] |= doc[1:] != doc[:-1]
            n_docs = np.add.reduceat(step.astype("i8"), start)
            if first is None:
                first = (int(h1[0]), int(h2[0]))
            # what goes on from the last batch, and what stays open, is handled row by row of hashes
            inner = np.ones(len(start), bool)
            inner[0] = inner[-1] = False
            drop = np.repeat(inner & (n_docs >= min_docs), end - start) & (doc != np.repeat(doc[start], end - start))
            if drop.any():
                yield rows(0, h1[drop], h2[drop], doc[drop], mark[drop], pos[drop], np.zeros(int(drop.sum()), "i8"))
            for k in {0, len(start) - 1}:
                a, b = int(start[k]), int(end[k])
                key = (int(h1[a]), int(h2[a]))
                if key != open_hash:
                    if open_hash is not None and open_hash == first:
                        yield totals(*open_hash, open_first, open_docs)
                    open_hash, open_first, open_docs, held = key, int(doc[a]), int(n_docs[k]), []
                else:
                    open_docs += int(n_docs[k]) - (int(doc[a]) == open_last)
                open_last = int(doc[b - 1])
                if key == first:  # may belong to an earlier range too: settled with its totals
                    yield rows(1, h1[a:b], h2[a:b], doc[a:b], mark[a:b], pos[a:b], np.zeros(b - a, "i8"))
                else:
                    held.append((h1[a:b], h2[a:b], doc[a:b], mark[a:b], pos[a:b]))
                    if k < len(start) - 1 or open_docs >= min_docs:
                        # the hash began in this range, so its first document is known
                        for p in held if open_docs >= min_docs else ():
                            if (late := p[2] != open_first).any():
                                yield rows(0, *(x[late] for x in p), np.zeros(int(late.sum()), "i8"))
                        held = []
        if open_hash is not None:
            for p in held:
                yield rows(1, *p, np.zeros(len(p[2]), "i8"))
            yield totals(*open_hash, open_first, open_docs)

    return sorted_lines.mapInArrow(run, "kind int, h1 long, h2 long, doc long, mark long, pos int, n long")


def dropped(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, mark, pos) of the lines that go."""
    spark = docs.sparkSession
    kept = written(lines(docs, min_chars), "lines")
    order = ["h1", "h2", F.desc("doc"), "mark", "pos"]
    ranged = kept.repartitionByRange(parts(spark), "h1", "h2", F.desc("doc")).sortWithinPartitions(*order)
    found = written(stream(ranged, min_docs), "decided")
    ends = found.where("kind = 2").groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("doc").alias("first"))
    ends = ends.where(F.col("n") >= min_docs)
    late = found.where("kind = 1").join(F.broadcast(ends.select("h1", "h2", "first")), ["h1", "h2"]).where("doc != first")  # two rows a task
    return found.where("kind = 0").select("doc", "mark", "pos").unionByName(late.select("doc", "mark", "pos"))


def bitmap(n: int, gone: np.ndarray) -> bytes:
    """Compressed bits of a document's lines, 1 for those that stay."""
    bits = np.ones(n, np.uint8)
    bits[gone] = 0
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def keep(n: int, packed: bytes) -> np.ndarray:
    """The lines' positions that a bitmap keeps."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n, bitorder="little"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, mark, last, keep) of each document that loses lines: ``keep`` has a bit for each line up to
    position ``last``, the last that goes; all later lines stay.  ``mark`` hashes the text."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = [np.array(x, "i8") for x in batch.column("gone").to_pylist()]
            last = [int(x.max()) for x in gone]
            packed = [bitmap(n + 1, x) for n, x in zip(last, gone)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), pa.array(last, pa.int32()), pa.array(packed, pa.binary())], ["doc", "mark", "last", "keep"])

    gone = dropped(docs, min_chars, min_docs).groupBy("doc", "mark").agg(F.collect_set("pos").alias("gone"))
    return gone.mapInArrow(build, "doc long, mark long, last int, keep binary")


def kept_lines(text: bytes, last: int | None, packed: bytes | None) -> tuple[int, list[bytes]]:
    """Number of lines, and those that stay."""
    own = text.split(b"\n")
    if packed is None:
        return len(own), own
    return len(own), [own[k] for k in keep(last + 1, packed)] + own[last + 1 :]


def with_bitmaps(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """Columns of ``docs`` plus __last, __keep (null: all lines stay)."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            own = pa.array([text_mark(x) for x in binary(batch.column(text_col))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], [*batch.schema.names, "__mark"])

    keyed = docs.withColumn("__doc", F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema) + ", `__mark` long"
    maps = keep_bitmaps(with_keys(id_text(docs, id_col, text_col)), min_chars, min_docs).toDF("__doc", "__mark", "__last", "__keep")
    return keyed.mapInArrow(mark, schema).join(maps, ["__doc", "__mark"], "left")


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Drop lines whose key at least ``min_docs`` documents hold, but in the largest ``doc_id`` holding it.

    Input: ``doc_id``, ``text``.  Output, one row per input row: ``doc_id``, ``n_lines`` (before),
    ``n_dropped``, ``kept_sha256`` (of the remaining lines joined by a line feed).  Null and empty
    texts are one empty line, which stays.  Rows that share a ``doc_id`` are one document when
    documents are counted; all null ids together are one, smaller than all others.  A line that
    is repeated in the document that keeps it stays each time.  An empty table gives no rows.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            n, gone, sha = [], [], []
            for text, last, packed in zip(binary(batch.column("text")), batch.column("__last").to_pylist(), batch.column("__keep").to_pylist()):
                size, rest = kept_lines(text, last, packed)
                n.append(size)
                gone.append(size - len(rest))
                sha.append(hashlib.sha256(text if packed is None else b"\n".join(rest)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    both = with_bitmaps(id_text(docs), "doc_id", "text", min_chars, min_docs)
    return both.select("doc_id", "text", "__last", "__keep").mapInArrow(report, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the lines gone from ``text`` (null stays null); all columns and rows are kept."""
    inner, own_id, own_text = numbered(docs)
    both = with_bitmaps(inner, own_id, own_text, min_chars, min_docs).select(*inner.columns, "__last", "__keep")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            old = batch.column(own_text)
            new = [None if t is None else t if p is None else b"\n".join(kept_lines(t, k, p)[1]) for t, k, p in zip(old.cast(pa.binary()).to_pylist(), batch.column("__last").to_pylist(), batch.column("__keep").to_pylist())]
            at = batch.schema.get_field_index(own_text)
            yield batch.set_column(at, pa.field(own_text, pa.string()), pa.array(new, pa.binary()).cast(pa.string())).select(names)

    names = inner.columns
    return both.mapInArrow(cut, inner.schema).toDF(*docs.columns)

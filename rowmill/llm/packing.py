"""Packing documents into sequences by large-item matching and best fit.

Only the counts of each length decide a packing, so the driver plans on a histogram
of at most ``capacity`` numbers, whatever the corpus' size: pieces above a third of
the capacity are matched greedily, at most two in a sequence; smaller ones, in
descending order, go where they leave the least room.  The plan says, for each
length and range of ranks, which sequences the pieces go to.  Spark ranks the
pieces of each length (salted, so a frequent length isn't one task's work) and
looks their places up.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.bpe import PATTERN, Encoder, Vocabulary, few
from rowmill.llm.common import id_text, parts, strings, written

CAPACITY = 2048
END_ID = 0


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoding:
    """Ids of a vocabulary given by ranks.  The library's splitting gives up on some million blanks or line
    feeds in a row; such a text is encoded by our own encoder, which is exact and has no such limit."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int]):
        import tiktoken

        self.library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.ranks, self.special, self.slow = ranks, special, None

    def encode(self, text: str, with_special: bool) -> np.ndarray:
        """With ``with_special`` the strings of special tokens become their ids, else they are ordinary text."""
        try:
            return self.library.encode_to_numpy(text, allowed_special=set(self.special) if with_special else set(), disallowed_special=())
        except ValueError:
            if self.slow is None:
                self.slow = Encoder(Vocabulary.of_ranks(self.ranks, self.special))
            return np.frombuffer((self.slow.encode if with_special else self.slow.plain)([text])[0], "<u4")


_ENCODING: dict[str, Encoding] = {}


def encoding(ranks: dict[bytes, int], special: dict[str, int]) -> Encoding:
    """The worker's encoding of this vocabulary."""
    if "own" not in _ENCODING:
        _ENCODING["own"] = Encoding(ranks, special)
    return _ENCODING["own"]


def pieces(docs: DataFrame, capacity: int = CAPACITY, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and the closing id, whole if they
    fit, else cut from the end into full pieces, so that only the first may be shorter."""
    with open(ranks_path or default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {"<|endoftext|>": len(ranks)}
    shared = docs.sparkSession.sparkContext.broadcast((ranks, special))
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(*shared.value)
        for batch in few(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text"))):
                ids = memoryview(own.encode(text, True).astype("<u4", copy=False).tobytes() + end)
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    size = (n % capacity or capacity) if k == 0 and n > capacity else min(capacity, n - at)
                    rows.append((doc, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
                    at, k = at + size, k + 1
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    return id_text(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, number, first sequence, pieces per sequence, offset) from the number
    of pieces of each length; rank r of a row goes to sequence ``first + (r - first rank) // per``."""
    left = counts.astype(np.int64).copy()
    used = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> sequences (first, number)
    bins = 0

    def place(size: int, number: int, first: int, per: int, offset: int) -> None:
        rows.append((size, int(used[size]), number, first, per, offset))
        used[size] += number
        left[size] -= number

    third = capacity // 3
    for size in range(capacity, third, -1):
        partner = min(size, capacity - size)
        while left[size]:
            while partner > third and not left[partner]:
                partner -= 1
            if partner > third and (partner < size or left[size] > 1):
                number = int(min(left[size], left[partner]) if partner < size else left[size] // 2)
                place(size, number, bins, 1, 0)
                place(partner, number, bins, 1, size)
                room[capacity - size - partner].append((bins, number))
            elif partner == size:
                partner -= 1
                continue
            else:
                number = int(left[size])
                place(size, number, bins, 1, 0)
                room[capacity - size].append((bins, number))
            bins += number
    for size in range(third, 0, -1):
        if not left[size]:
            continue
        for gap in sorted(g for g, own in room.items() if g >= size and own):
            own = room.pop(gap)
            while own and left[size]:
                first, number = own.pop()
                per = gap // size
                full = int(min(number, left[size] // per))
                if full:
                    place(size, full * per, first, per, capacity - gap)
                    room[gap - per * size].append((first, full))
                if full < number:
                    some = int(min(per, left[size]))
                    if some:
                        place(size, some, first + full, some, capacity - gap)
                        room[gap - some * size].append((first + full, 1))
                        full += 1
                    if full < number:
                        own.append((first + full, number - full))
            if own:
                room[gap].extend(own)
            if not left[size]:
                break
        per = capacity // size
        if full := int(left[size]) // per:
            place(size, full * per, bins, per, 0)
            room[capacity - per * size].append((bins, full))
            bins += full
        if some := int(left[size]):
            place(size, some, bins, some, 0)
            room[capacity - some * size].append((bins, 1))
            bins += 1
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces (it is read twice)."""
    spark = pieces.sparkSession
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts(spark))).cast("int"))
    number = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in number.groupBy("length").agg(F.sum("__n").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    rows = plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    base = number.select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("__rank", F.row_number().over(within) - 1).join(base, ["length", "__salt"]).withColumn("__rank", F.col("__rank") + F.col("__base"))
    shared = spark.sparkContext.broadcast(rows)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        key = rows[:, 0] << 44 | rows[:, 1]
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("__rank").to_numpy()
            at = np.searchsorted(key, size << 44 | rank, "right") - 1
            k = rank - rows[at, 1]
            sequence = rows[at, 3] + k // rows[at, 4]
            offset = rows[at, 5] + k % rows[at, 4] * size
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    return ranked.select(*columns, "__rank").mapInArrow(look_up, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, ranks_path: str | None = None) -> DataFrame:
    """Pack all documents into as few sequences of ``capacity`` ids as the method finds.

    Input: ``doc_id``, ``text``.  Output: one row per piece, with its place.  A null or empty text
    is the closing id alone; repeated rows are packed each for itself; a null ``doc_id`` stays
    null; an empty table gives no rows.  Sequences are numbered from 0 and have no gaps before
    their last piece.
    """
    return pack(written(pieces(docs, capacity, ranks_path), "pieces"), capacity)

"""Exact deduplication with a cuckoo-filter index over live digests.

The index has two parts, both tables in Spark:

* *members*: one row per live document, (doc_id, uid, digest of its whole normalised text);
* *state*: by bucket (a share of the digests' hash space) one compressed cuckoo filter, and the bucket's
  content: each live digest with its number of documents and the one that stays.

Rows to add are combined inside their task, shuffled by bucket and streamed through the bucket's
filter.  A miss proves that the digest isn't live: it goes into filter and content.  A hit is verified
against the content, since fingerprints may agree by chance.  A filter that overflows is built
anew, twice as large, from the stored keys; so are all filters when buckets have grown too
large and are split.  When a digest's last document is deleted, its fingerprint leaves the filter.

Only digests travel, never texts; a text that a third of all documents share is one row a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm.common import id_text, parts, ship_code, written

SLOTS = 4
#: Evictions tried before a filter counts as full.
KICKS = 200
#: Keys that a new filter has room for.
FIRST_KEYS = 256
#: Digests a bucket may hold on average; more buckets are made beyond that.
BUCKET_KEYS = 100_000
#: Different digests that a task combines before it passes them on.
COMBINE_ENTRIES = 100_000

STATE = "bucket long, filter binary, digest binary, doc_id long, uid long, n long"
CHANGES = "bucket long, op int, digest binary, doc_id long, uid long, n long"
ADD, SET = 1, 2


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four slots; each has two possible buckets."""

    def __init__(self, keys: int = FIRST_KEYS, table: np.ndarray | None = None):
        if table is None:
            buckets = 1 << max(2, (max(1, keys) * 20 // 19 // SLOTS).bit_length())
            table = np.zeros((buckets, SLOTS), np.uint16)
        self.table = table.tolist()
        self.mask = len(self.table) - 1

    @classmethod
    def loads(cls, data: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(zlib.decompress(data), np.uint16).reshape(-1, SLOTS))

    def dumps(self) -> bytes:
        return zlib.compress(np.array(self.table, np.uint16).tobytes(), 1)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint (never 0, which marks a free slot) and the two buckets; each follows from the other."""
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[10:18], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, at: int, mark: int) -> int:
        return (at ^ (mark * 0x5BD1E995)) & self.mask

    def may_hold(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.table[a] or mark in self.table[b]

    def insert(self, digest: bytes) -> bool:
        """False: no room.  The filter must be built anew then, since the last mark evicted is lost."""
        mark, a, b = self._places(digest)
        for at in (a, b):
            if 0 in self.table[at]:
                self.table[at][self.table[at].index(0)] = mark
                return True
        for kick in range(KICKS):
            slot = (kick + mark) % SLOTS
            mark, self.table[b][slot] = self.table[b][slot], mark
            b = self._other(b, mark)
            if 0 in self.table[b]:
                self.table[b][self.table[b].index(0)] = mark
                return True
        return False

    def delete(self, digest: bytes) -> None:
        """Only for digests that are in."""
        mark, a, b = self._places(digest)
        at = self.table[a] if mark in self.table[a] else self.table[b]
        at[at.index(mark)] = 0


class Bucket:
    """A filter and the content it stands for, while its task works on it."""

    def __init__(self, data: bytes | None, content: dict[bytes, tuple]):
        self.content = content  # digest -> (doc_id, uid, n)
        self.verified = self.resized = 0
        if data is None:
            self._rebuild(max(FIRST_KEYS, len(content)))
        else:
            self.filter = CuckooFilter.loads(data)

    def _rebuild(self, keys: int) -> None:
        """A filter for ``keys`` digests, or more if they don't fit, from the stored keys."""
        while True:
            self.filter = CuckooFilter(keys)
            if all(map(self.filter.insert, self.content)):
                return
            keys *= 2

    def find(self, digest: bytes) -> tuple | None:
        if not self.filter.may_hold(digest):
            return None
        self.verified += 1
        return self.content.get(digest)

    def put(self, digest: bytes, entry: tuple) -> None:
        """A digest that ``find`` didn't find."""
        self.content[digest] = entry
        if not self.filter.insert(digest):
            self.resized += 1
            self._rebuild(2 * len(self.content))

    def add(self, digest: bytes, doc_id: int | None, uid: int, n: int) -> None:
        held = self.find(digest)
        if held is None:
            self.put(digest, (doc_id, uid, n))
        else:
            self.content[digest] = (*min(held[:2], (doc_id, uid), key=stays_first), held[2] + n)

    def set(self, digest: bytes, doc_id: int | None, uid: int, n: int) -> None:
        """What is left of a digest after deletions; nothing if n is 0."""
        held = self.find(digest)
        if n and held is None:
            self.put(digest, (doc_id, uid, n))
        elif n:
            self.content[digest] = (doc_id, uid, n)
        elif held is not None:
            self.filter.delete(digest)
            del self.content[digest]


def stays_first(row: tuple) -> tuple:
    """Order in which rows are preferred: smallest doc_id, null last; then the row's own number."""
    return (row[0] is None, row[0] or 0, row[1])


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, uid, digest), stored: SHA-256 of every whole normalised text; uid numbers the rows."""
    own = id_text(docs, id_col, text_col)
    return written(own.select("doc_id", F.monotonically_increasing_id().alias("uid"), F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest")), "digests")


def in_bucket(buckets: int) -> Column:
    """A digest's bucket: its first four bytes, modulo the number of buckets."""
    return F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % F.lit(buckets)


def combined(members: DataFrame) -> DataFrame:
    """(op, digest, doc_id, uid, n): of each digest one row a task (or some, beyond ``COMBINE_ENTRIES``)."""
    names = ["op", "digest", "doc_id", "uid", "n"]

    def rows(seen: dict[bytes, tuple]) -> pa.RecordBatch:
        doc, uid, n = zip(*seen.values())
        return pa.RecordBatch.from_arrays([pa.array([ADD] * len(n), pa.int32()), pa.array(list(seen), pa.binary()), pa.array(doc, pa.int64()), pa.array(uid, pa.int64()), pa.array(n, pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        for batch in batches:
            for doc, uid, digest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "uid", "digest"))):
                held = seen.get(digest)
                seen[digest] = (doc, uid, 1) if held is None else (*min(held[:2], (doc, uid), key=stays_first), held[2] + 1)
            if len(seen) >= COMBINE_ENTRIES:
                yield rows(seen)
                seen = {}
        if seen:
            yield rows(seen)

    return members.mapInArrow(run, "op int, digest binary, doc_id long, uid long, n long")


def changed(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The state after the changes, bucket by bucket."""

    def run(key: tuple, old: pa.Table, new: pa.Table) -> pa.Table:
        data, content = None, {}
        for blob, digest, doc, uid, n in zip(*(old.column(c).to_pylist() for c in ("filter", "digest", "doc_id", "uid", "n"))):
            if blob is not None:
                data = blob
            else:
                content[digest] = (doc, uid, n)
        bucket = Bucket(data, content)
        for op, digest, doc, uid, n in zip(*(new.column(c).to_pylist() for c in ("op", "digest", "doc_id", "uid", "n"))):
            (bucket.add if op == ADD else bucket.set)(digest, doc, uid, n)
        doc, uid, n = zip(*bucket.content.values()) if bucket.content else ((), (), ())
        at = next(x[0].as_py() for x in (old.column("bucket"), new.column("bucket")) if len(x))
        # the filter's own row tells how often it was built anew and how many hits were verified
        columns = [
            pa.array([at] * (len(n) + 1), pa.int64()), pa.array([bucket.filter.dumps()] + [None] * len(n), pa.binary()), pa.array([None, *bucket.content], pa.binary()),
            pa.array([None, *doc], pa.int64()), pa.array([bucket.resized, *uid], pa.int64()), pa.array([bucket.verified, *n], pa.int64()),
        ]
        return pa.Table.from_arrays(columns, names=[x.split()[0] for x in STATE.split(", ")])

    return state.groupBy("bucket").cogroup(changes.groupBy("bucket")).applyInArrow(run, STATE)


@dataclass(frozen=True)
class DedupIndex:
    """Immutable: ``insert`` and ``delete`` return the index after the change."""

    members: DataFrame
    state: DataFrame
    buckets: int

    @staticmethod
    def empty(spark: SparkSession, buckets: int = 1) -> DedupIndex:
        ship_code(spark)
        return DedupIndex(spark.createDataFrame([], "doc_id long, uid long, digest binary"), spark.createDataFrame([], STATE), max(1, buckets))

    def keys(self) -> DataFrame:
        """(digest, keep_id, keep_uid, n): each live digest, the document that stays, and how many hold it."""
        return self.state.where("digest is not null").select("digest", F.col("doc_id").alias("keep_id"), F.col("uid").alias("keep_uid"), "n")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DedupIndex:
        """Add every row of ``docs``."""
        first = self.members.agg(F.coalesce(F.max("uid") + 1, F.lit(0)).alias("m")).first()["m"]
        new = digests(docs, id_col, text_col).withColumn("uid", F.col("uid") + F.lit(first))
        members = self.members.unionByName(new) if first else new
        buckets, state = self._room(members.count())
        changes = combined(new).withColumn("bucket", in_bucket(buckets))
        return DedupIndex(members, written(changed(state, changes), "state"), buckets)

    def _room(self, rows: int) -> tuple[int, DataFrame]:
        """Number of buckets for an index of ``rows`` documents, and the state dealt out to them; filters of
        buckets that are split go, and are built anew from the stored keys."""
        least = max(parts(self.members.sparkSession), -(-rows // BUCKET_KEYS))
        if least <= self.buckets:
            return self.buckets, self.state
        keys = self.state.where("digest is not null").withColumn("bucket", in_bucket(least))
        return least, keys.select(*[x.split()[0] for x in STATE.split(", ")])

    def delete(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DedupIndex:
        """Take out every live row that has both the doc_id and the normalised text of a row of ``docs``.

        Digests that lose documents are counted anew from the members that are left; of a
        document that stayed, the next smallest takes the place.
        """
        gone = digests(docs, id_col, text_col).select(F.col("doc_id").alias("g"), F.col("digest").alias("d")).distinct()
        hit = self.members.doc_id.eqNullSafe(gone.g) & (self.members.digest == gone.d)
        members = written(self.members.join(gone, hit, "left_anti"), "members")
        touched = gone.select(F.col("d").alias("digest")).distinct()
        best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid"))
        left = members.join(touched, "digest", "left_semi").groupBy("digest").agg(best.alias("m"), F.count(F.lit(1)).alias("n"))
        changes = touched.join(left, "digest", "left").select(
            F.lit(SET).alias("op"), "digest", F.col("m.doc_id").alias("doc_id"), F.coalesce("m.uid", F.lit(0)).alias("uid"), F.coalesce("n", F.lit(0)).alias("n"))
        return DedupIndex(members, written(changed(self.state, changes.withColumn("bucket", in_bucket(self.buckets))), "state"), self.buckets)

    def contains(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(doc_id, keep_id, n) for every row of ``docs``: the live document with its text, null if none."""
        own = digests(docs, id_col, text_col).select("doc_id", "digest")
        return own.join(self.keys().select("digest", "keep_id", "n"), "digest", "left").select("doc_id", "keep_id", "n")

    def report(self) -> DataFrame:
        """One row per live document: (doc_id, keep_id, group_size, kept, text_sha256)."""
        both = self.members.join(self.keys(), "digest")
        return both.select("doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("uid") == F.col("keep_uid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def dedup_report(docs: DataFrame) -> DataFrame:
    """Which documents are exact copies, up to white space, and which one of them stays.

    Input: ``doc_id``, ``text``; other columns, whatever their names, aren't read.  Output, one row per
    input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.  Texts are equal when
    each run of ASCII white space counts as one space; null counts as empty, so null and empty
    texts are one group, and texts of white space alone are another.  The row of the smallest ``doc_id``
    stays; a null id counts as larger than all others.  Of rows repeated whole (or that share the
    smallest id), all count in ``group_size`` and just one is kept.  An empty table gives no rows.
    """
    return DedupIndex.empty(docs.sparkSession).insert(docs).report()

"""N-gram Jaccard self-join with Bayesian candidate pruning.

A document is the set of its word five-grams.  Documents with equal sets are one node.

1. MinHash bands (40 of 5 values: a pair at similarity 0.8 is missed with probability
   1.2e-7) give buckets.
2. Inside a bucket, pairs are compared on a few MinHash values and dropped when the
   posterior probability of reaching the threshold falls below the tolerance.  Only as many
   edges as connect the rest are kept.  Members of very large buckets are connected
   unseen, which loses nothing and stays linear.
3. Connected nodes come together, in blocks if they are many.  There all pairs are compared
   on ever more MinHash values, dropped as soon as the posterior allows it, and the
   survivors verified exactly on their sets.  Only counts of links and connecting
   edges leave a task, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.bpe import few
from rowmill.llm.common import id_text, numbered, parts, saved, strings, written

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5
HASHES = 128  # compared at most before a pair is verified
STEP = 16
SKETCH = 32  # MinHash values that travel with a bucket's members
TOLERANCE = 1e-6
LARGE_BUCKET = 512
BLOCK_SHINGLES = 1_500_000
BLOCK_NODES = 4096

_RNG = np.random.default_rng(20240607)
_MUL = _RNG.integers(1, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32)
_WORD = regex.compile(r"[\p{L}\p{N}_]+").findall


class _Hashes(dict):
    """64-bit hash of a word, kept."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _Hashes()


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams: lower case, words are runs of letters,
    digits and underscores.  A text of fewer words is one shingle, one without words has none."""
    own = _WORD(text.lower())
    if not own:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASH.__getitem__, own), np.uint64, len(own))
    n = max(1, len(own) - words + 1)
    total = np.full(n, len(own) if len(own) < words else words, np.uint64)
    for k in range(min(words, len(own))):
        total = (total ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return np.unique(total)


def min_hashes(own: np.ndarray, number: int = BANDS * ROWS) -> np.ndarray:
    """MinHash values of a set."""
    x = (own ^ (own >> np.uint64(32))).astype(np.uint32)
    low = np.full(number, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 256):
        h = x[at : at + 256, None] * _MUL[:number] + _ADD[:number]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        np.minimum(low, h.min(0), out=low)
    return low


def least_matches(compared: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest matches among ``compared`` MinHash values that keep a pair.  With a uniform prior the
    similarity's posterior after m matches is Beta(m + 1, compared - m + 1); its upper tail at the
    threshold is the probability of at most m successes in compared + 1 trials."""
    tail = 0.0
    for m in range(compared + 1):
        tail += comb(compared + 1, m) * threshold**m * (1 - threshold) ** (compared + 1 - m)
        if tail >= tolerance:
            return m
    return compared


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, th, s1, s2, n, bands, sketch) per row; s1, s2 are a 128-bit hash of the set (without
    words: of the text, null as empty), th a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for batch in few(batches):
            s1, s2, n, bands, sketch = [], [], [], [], []
            for text in strings(batch.column("text")):
                own = shingles(text)
                n.append(len(own))
                a, b = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes() or b"text:" + text.encode()), "<i8").tolist()
                s1.append(a)
                s2.append(b)
                if not len(own):  # no words: equal to equal texts only, and in no bucket
                    bands.append([])
                    sketch.append(b"")
                    continue
                low = min_hashes(own)
                key = salt.copy()
                for r in range(ROWS):
                    key = (key ^ low[r::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(32)
                bands.append(key.view(np.int64))
                sketch.append(low[:SKETCH].astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(n, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                ["doc_id", "th", "s1", "s2", "n", "bands", "sketch"],
            )

    hashed = docs.withColumn("th", F.xxhash64("text"))
    return hashed.mapInArrow(run, "doc_id long, th long, s1 long, s2 long, n long, bands array<long>, sketch binary")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key of sorted batches, in bounded memory but for one key's rows."""
    held: list[pa.RecordBatch] = []
    at: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for x in own:
            new[1:] |= x[1:] != x[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(x[a] for x in own)
            if key != at and held:
                yield pa.Table.from_batches(held)
                held = []
            at = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Smallest index connected with each of n items."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, left, label[right])
        np.minimum.at(low, right, label[left])
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def bucket_edges(members: DataFrame) -> DataFrame:
    """(a, b) edges that connect the pairs of each bucket that the posterior doesn't rule out."""
    least = least_matches(SKETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        size = 0
        for group in runs(batches, ["bucket"]):
            node = group.column("node").to_numpy()
            own = np.frombuffer(b"".join(group.column("sketch").to_pylist()), "<u2").reshape(len(node), SKETCH)
            same = np.zeros((len(node), len(node)), np.uint8)
            for k in range(SKETCH):
                same += own[:, k, None] == own[None, :, k]
            i, j = np.nonzero(np.triu(same >= least, 1))
            label = forest(i, j, len(node))
            some = label != np.arange(len(node))
            a.append(node[some])
            b.append(node[label[some]])
            size += int(some.sum())
            if size > 100_000:
                yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})
                a, b, size = [], [], 0
        if size:
            yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})

    return members.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node connected with it.  Alternates large and small stars,
    whose edges never grow in number; each round is stored in the shared folder."""

    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        if not small:
            both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        near = both.join(low, "u")
        if small:
            out = near.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        else:
            out = near.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return out.where("a != b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = saved(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(edges)
    while True:
        edges = saved(star(star(edges, False), True))
        now = state(edges)
        if now == before:
            break
        before = now
    own = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return own.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of left, j of right, i != j; once if left is right) of similar sets: pruned on ever
    more MinHash values, then verified exactly."""
    sig = np.stack([min_hashes(s, HASHES) for s in sets])
    n = np.array([len(s) for s in sets], np.int64)
    limit = Fraction(str(threshold))
    up, down = limit.numerator, limit.denominator
    same_side = left is right
    i_all, j_all = [], []
    least = {k: least_matches(k, threshold, tolerance) for k in range(STEP, HASHES + 1, STEP)}
    for at in range(0, len(left), 256):
        rows = left[at : at + 256]
        match = np.zeros((len(rows), len(right)), np.uint8)
        for k in range(STEP):
            match += sig[rows, k, None] == sig[right, k]
        ok = match >= least[STEP]
        low, high = np.minimum.outer(n[rows], n[right]), np.maximum.outer(n[rows], n[right])
        ok &= low * down >= high * up  # sizes alone allow it
        if same_side:
            ok &= np.arange(at, at + len(rows))[:, None] < np.arange(len(right))
        i, j = np.nonzero(ok)
        m = match[i, j].astype(np.int64)
        i, j = rows[i], right[j]
        for k in range(STEP, HASHES, STEP):
            m += (sig[i, k : k + STEP] == sig[j, k : k + STEP]).sum(1)
            ok = m >= least[k + STEP]
            i, j, m = i[ok], j[ok], m[ok]
        i_all.append(i)
        j_all.append(j)
    i, j = np.concatenate(i_all), np.concatenate(j_all)
    if not len(i):
        return i, j
    universe, codes = np.unique(np.concatenate(sets), return_inverse=True)
    end = np.cumsum(n)
    has = np.zeros(len(universe), bool)
    keep = np.zeros(len(i), bool)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    cuts = np.append(np.flatnonzero(np.r_[True, i[1:] != i[:-1]]), len(i))
    for a, b in zip(cuts[:-1], cuts[1:]):
        k = i[a]
        own = codes[end[k] - n[k] : end[k]]
        has[own] = True
        for x in range(a, b, 4096):
            mate = j[x : min(b, x + 4096)]
            flat = np.concatenate([codes[end[q] - n[q] : end[q]] for q in mate])
            common = np.add.reduceat(has[flat].astype(np.int64), np.cumsum(n[mate]) - n[mate])
            keep[x : x + len(mate)] = common * down >= (n[k] + n[mate] - common) * up
        has[own] = False
    return i[keep], j[keep]


def block_links(blocks: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(node, links, root, many) from blocks (comp, x, y, node, side, copies, many, own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["comp", "x", "y"]):
            node, side = group.column("node").to_numpy(), group.column("side").to_numpy()
            copies = group.column("copies").to_numpy()
            sets = [np.frombuffer(s, "<u8") for s in group.column("own").to_pylist()]
            every = np.arange(len(node))
            one = group.column("x")[0].as_py() == group.column("y")[0].as_py()
            left, right = (every, every) if one else (every[side == 0], every[side == 1])
            if one:
                right = left
            i, j = linked(sets, left, right, threshold, tolerance) if len(left) and len(right) else (every[:0], every[:0])
            links = np.zeros(len(node), np.int64)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            root = forest(i, j, len(node))
            yield pa.RecordBatch.from_pydict({"node": node, "links": links, "root": node[root], "many": group.column("many").combine_chunks()})

    return blocks.mapInArrow(run, "node long, links long, root long, many boolean")


def one_a_task(texts: DataFrame) -> DataFrame:
    """Rows (text, th) with a hash that none before in their task had: a text that a third of all documents share
    leaves each task once, however many copies it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for batch in batches:
            own, first = np.unique(batch.column("th").to_numpy(), return_index=True)
            new = ~np.isin(own, seen, assume_unique=True)
            seen = np.concatenate([seen, own[new]])
            yield batch.take(pa.array(np.sort(first[new])))

    return texts.mapInArrow(run, "text string, th long")


def similar(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Class and links of every row of ``docs`` (``doc_id``, ``text``): (doc_id, th, class, class_id,
    n_links).

    ``class_id`` is the smallest doc_id of the documents connected through pairs of similarity
    ``threshold`` or more, ``n_links`` the number of such pairs the row is in, copies counted
    each.  Texts without words are similar to equal texts only (null counts as empty).  Rows that
    share a doc_id or lack one are documents of their own, and nulls never name a class that
    has another id.  The bands are set for thresholds from 0.8 up.
    """
    if threshold < THRESHOLD:
        raise ValueError(f"the bands find pairs of similarity {THRESHOLD} or more")
    spark = docs.sparkSession
    own = written(signatures(docs), "signatures")
    distinct = own.groupBy("s1", "s2").agg(F.count("*").alias("copies"), F.min("n").alias("n"), F.min("th").alias("th"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    nodes = written(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")

    band = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = band.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("first")).where("size > 1")
    member = written(band.join(sizes, "bucket"), "members")
    large = member.where(f"size > {LARGE_BUCKET} and node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    sketched = member.where(f"size <= {LARGE_BUCKET}").select("bucket", "node").join(nodes.select("node", "sketch"), "node")
    small = bucket_edges(sketched.repartition(parts(spark), "bucket").sortWithinPartitions("bucket", "node"))
    label = components(small.unionByName(large)).toDF("node", "comp")

    size = label.join(nodes.select("node", "n", "copies", "th", "s1", "s2"), "node")
    total = size.groupBy("comp").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_NODES)).cast("int").alias("g"))
    placed = size.join(total, "comp").withColumn("block", F.pmod(F.xxhash64("node"), "g").cast("int"))
    text = one_a_task(docs.select("text", F.xxhash64("text").alias("th"))).join(placed, "th")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["comp", "node", "copies", "g", "block", "own"]
        for batch in few(batches):
            made = [shingles(t) for t in strings(batch.column("text"))]
            mark = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8").tolist() for s in made]
            same = pa.array([a == [x, y] for a, x, y in zip(mark, batch.column("s1").to_pylist(), batch.column("s2").to_pylist())])
            full = pa.array([s.astype("<u8").tobytes() for s in made], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), full], names).filter(same)

    owned = text.select("text", "s1", "s2", "comp", "node", "copies", "g", "block").mapInArrow(sets, "comp long, node long, copies long, g int, block int, own binary")
    owned = owned.groupBy("node").agg(*(F.first(c).alias(c) for c in ("comp", "copies", "g", "block", "own")))
    spread = owned.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    x, y = F.least("block", "other"), F.greatest("block", "other")
    blocks = spread.select("comp", x.alias("x"), y.alias("y"), "node", (F.col("block") != x).cast("int").alias("side"), "copies", (F.col("g") > 1).alias("many"), "own")
    blocks = blocks.repartition(parts(spark), "comp", "x", "y").sortWithinPartitions("comp", "x", "y", "node")
    found = written(block_links(blocks, threshold, tolerance), "links")
    across = found.where("many and node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    joined = components(across) if found.where("many").take(1) else None
    per_node = found.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    if joined is not None:
        per_node = per_node.join(joined, "node", "left").withColumn("root", F.coalesce("label", "root")).drop("label")

    per_set = nodes.select("s1", "s2", "node", "copies").join(per_node, "node", "left")
    per_set = per_set.select("s1", "s2", F.coalesce("root", "node").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    rows = own.select("doc_id", "th", "s1", "s2").join(per_set, ["s1", "s2"])
    # a table of its own, so that Spark may split the rows of a class that holds many documents
    named = written(rows.groupBy("class").agg(F.min("doc_id").alias("class_id")), "class_ids")
    return rows.join(named, "class").select("doc_id", "th", "class", "class_id", F.col("n_links").cast("long").alias("n_links"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, class_id, n_links) of every row; see :func:`similar`."""
    return similar(id_text(docs), threshold, tolerance).select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with one document of each class: the smallest doc_id, of equal ones the smallest text
    hash; of identical rows one.  Of equal texts without words (null as empty) one stays too."""
    own = written(similar(id_text(docs), threshold, tolerance), "classes")
    best = own.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "th")).alias("best"), F.count("*").alias("size"))
    gone = own.join(best.where("size > 1"), "class")
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("th") == F.col("best.th"))
    marked = gone.groupBy("doc_id", "th").agg(F.max(stays).alias("__stays"), F.count("*").alias("__rows"))
    marked = marked.toDF("__id", "__th", "__stays", "__rows")
    inner, own_id, own_text = numbered(docs)
    keyed = inner.withColumn("__hash", F.xxhash64(F.col(own_text).cast("string")))
    both = keyed.join(marked, F.col(own_id).cast("long").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th")), "left")
    once = both.where("__stays is null or (__stays and __rows = 1)").select(inner.columns)
    again = both.where("__stays and __rows > 1")
    first = Window.partitionBy("__id", "__th").orderBy(F.to_json(F.struct(*inner.columns)))
    again = again.withColumn("__k", F.row_number().over(first)).where("__k = 1").select(inner.columns)
    return once.unionByName(again).toDF(*docs.columns)

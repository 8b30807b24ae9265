"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Vectors are searched in classes of similar norms, those within a factor of two, so that a few long ones
don't squeeze all others into one place; a query asks every class.  In a class, vectors are scaled to
norms up to 1 and get one more coordinate, sqrt(1 - |x|^2), so that nearness between points is
nearness of directions; queries get a zero there.  Equal vectors are one node.

Build: a few partitions by nearest pivot, in blocks of bounded size, give every node
first neighbours; the number of pivots grows with the nodes, up to a bound.  Then rounds of Spark joins: each
node meets its neighbours and those it is a neighbour of, with their vectors; every two of
them of which one is new there are compared, and what improves a list is sent to it.  Rounds
go on until they change hardly anything.

Search: every query keeps a beam.  It starts from seeds, some nodes of the cells whose pivots are
nearest to it; cells, and with them seeds, grow in number with the nodes.  Each round takes the
best nodes not yet expanded, joins them with their neighbours, and those with their vectors,
and merges what scores higher, until all beams are expanded.  Nodes live in partitions by
number, so a request goes to the partition with an array of nodes; seeds are joined by cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowmill.llm.common import parts, some_rows, written
from rowmill.llm.vectors import distinct, matrix, packed, unpack, usable, width
from rowmill.sinks.scratch import discard

NEIGHBOURS = 32
SAMPLE = 20  # neighbours of each direction that meet in a round
TREES = 4
BLOCK = 4096
PART = 2048
CELLS = 16_384  # pivots of a partition at most, so what is broadcast is bounded: 4 (components + 1) bytes each
PIVOTS = 512  # more than so many are compared by way of groups
GROUPS = 4  # groups looked at
TOLERANCE = 0.001  # share of list entries that a round must change for another to follow
BEAM = 320
EXPAND = 160
SEEDS = 128  # of each cell
PROBES = 2  # cells of each partition that a query starts from
EXACT = 3  # times k: candidates of each class rescored in double precision
CLASSES = 40  # the last one has all that is shorter than the longest vector by 2^39 and more


def nodes_of(points: DataFrame, wide: int, top: float, p: int) -> DataFrame:
    """(part, node, vec, v, ids): node numbers are place * parts + part, so a node's part and its place
    in it follow from the number."""
    def lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), "<f8", wide) / top
            rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1)))
            raw = [r.tobytes() for r in np.column_stack([x, rest]).astype("<f4")]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("node"), pa.array(raw, pa.binary()), batch.column("v"), batch.column("ids")], ["part", "node", "vec", "v", "ids"])

    own = points.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(p)).cast("int"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("v")) - 1
    own = own.withColumn("node", place.cast("long") * p + F.col("part"))
    return written(own.mapInArrow(lift, "part int, node long, vec binary, v binary, ids array<long>"), "nodes")


def best(node: np.ndarray, other: np.ndarray, score: np.ndarray, k: int, old: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The k best different others of each node, best first; old: kept if any of the equal entries is."""
    old = np.zeros(len(node), bool) if old is None else old
    order = np.lexsort((~old, other, node))
    node, other, score, old = node[order], other[order], score[order], old[order]
    one = np.ones(len(node), bool)
    one[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
    node, other, score, old = node[one], other[one], score[one], old[one]
    order = np.lexsort((other, -score, node))
    node, other, score, old = node[order], other[order], score[order], old[order]
    start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
    rank = np.arange(len(node)) - np.repeat(start, np.diff(np.append(start, len(node))))
    keep = rank < k
    return node[keep], other[keep], score[keep], old[keep]


LISTS = "part int, node long, near array<long>, score array<float>, old array<boolean>"


def lists(node: np.ndarray, other: np.ndarray, score: np.ndarray, old: np.ndarray, p: int) -> pa.Table:
    """One row per node of sorted entries."""
    start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
    at = pa.array(np.append(start, len(node)), pa.int32())
    name = node[start]
    arrays = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (other, score.astype(np.float32), old)]
    return pa.table([pa.array((name % p).astype(np.int32)), pa.array(name), *arrays], ["part", "node", "near", "score", "old"])


def flat(t: pa.Table) -> tuple[np.ndarray, ...]:
    """Entries (node, other, score, old) of rows of lists."""
    offset, other = unpack(t.column("near"))
    node = np.repeat(t.column("node").to_numpy(), np.diff(offset))
    return node, other, unpack(t.column("score"))[1], unpack(t.column("old"))[1].astype(bool)


def merged(entries: DataFrame, k: int, p: int) -> DataFrame:
    """The k best of all lists of each node, worked out a part at a time."""

    def run(t: pa.Table) -> pa.Table:
        return lists(*best(*flat(t)[:3], k, flat(t)[3]), p)

    return entries.groupBy("part").applyInArrow(run, LISTS)


class Cells:
    """Partitions of the nodes by nearest pivot: ``keyed`` (tree, pivot, node, vec), and what the pivots are:
    of each tree the nodes, the vectors and their groups."""

    def __init__(self, keyed: DataFrame, pivots: Broadcast, number: int):
        self.keyed, self.pivots, self.number = keyed, pivots, number


def cells_of(nodes: DataFrame, dim: int, n: int) -> Cells:
    """Cells over several sets of pivots, one pivot for half a block of nodes, up to ``CELLS``; larger cells are
    cut into blocks by a hash, another one in each set, and the descent brings their parts together."""
    spark = nodes.sparkSession
    number = int(max(1, min(CELLS, n // (BLOCK // 2))))
    trees = TREES if number > 1 or n > BLOCK else 1
    taken = some_rows(nodes.select("node", "vec"), number * trees, F.xxhash64("vec")).collect()
    name, x = np.array([r["node"] for r in taken]), np.frombuffer(b"".join(bytes(r["vec"]) for r in taken), "<f4").reshape(-1, dim)
    pivots = spark.sparkContext.broadcast([(name[t::trees], x[t::trees], grouped(x[t::trees]) if number > PIVOTS else None) for t in range(trees)])

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vec"), "<f4", dim)
            for t, (_, own, group) in enumerate(pivots.value):
                near = nearest_pivots(x, own, group, 1)[0][:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(near.astype(np.int32)), batch.column("node"), batch.column("vec")], ["tree", "pivot", "node", "vec"])

    return Cells(written(nodes.select("node", "vec").mapInArrow(key, "tree int, pivot int, node long, vec binary"), "blocks"), pivots, number)


def grouped(pivots: np.ndarray) -> np.ndarray:
    """The group of each pivot: the nearest of the first few, about the square root of their number."""
    few = pivots[: int(np.ceil(np.sqrt(len(pivots))))]
    return np.concatenate([(pivots[at : at + 4096] @ few.T).argmax(1) for at in range(0, len(pivots), 4096)])


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, group: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k pivots of the highest inner product with each row (lifted pivots are of one length), and those;
    with groups, of the pivots in the few groups nearest to the row, where a pivot may be given twice."""
    k = min(k, len(pivots))
    if group is None:
        s = x @ pivots.T
        top = np.argsort(-s, 1, kind="stable")[:, :k] if k > 1 else s.argmax(1)[:, None]
        return top, np.take_along_axis(s, top, 1)
    number = int(np.ceil(np.sqrt(len(pivots))))
    close = np.argsort(-(x @ pivots[:number].T), 1, kind="stable")[:, :GROUPS]
    top, value = np.tile(close[:, :1], k), np.full((len(x), k), -np.inf, np.float32)
    for g in range(number):
        row, own = np.flatnonzero((close == g).any(1)), np.flatnonzero(group == g)
        if len(row) and len(own):
            both = np.concatenate([value[row], x[row] @ pivots[own].T], 1)
            name = np.concatenate([top[row], np.tile(own, (len(row), 1))], 1)
            order = np.argsort(-both, 1, kind="stable")[:, :k]
            top[row], value[row] = np.take_along_axis(name, order, 1), np.take_along_axis(both, order, 1)
    return top, (x[:, None] * pivots[top]).sum(2)


def first_lists(cells: Cells, dim: int, p: int) -> DataFrame:
    """Neighbours within blocks of nodes that share a cell."""
    keyed = cells.keyed
    size = keyed.groupBy("tree", "pivot").agg(F.ceil(F.count("*") / BLOCK).alias("g"))  # a row for each cell: at most TREES * CELLS
    placed = keyed.join(F.broadcast(size), ["tree", "pivot"]).withColumn("block", F.pmod(F.xxhash64("node", "tree"), "g"))

    def run(t: pa.Table) -> pa.Table:
        x, node = matrix(t.column("vec"), "<f4", dim), t.column("node").to_numpy()
        k = min(NEIGHBOURS, len(x) - 1)
        out = []
        for at in range(0, len(x) if k else 0, 512):
            s = x[at : at + 512] @ x.T
            s[np.arange(len(s)), at + np.arange(len(s))] = -np.inf
            top = np.argpartition(-s, k - 1, 1)[:, :k]
            out.append((np.repeat(node[at : at + 512], k), node[top].ravel(), np.take_along_axis(s, top, 1).ravel()))
        if not out:
            return lists(node[:0], node[:0], np.zeros(0, np.float32), np.zeros(0, bool), p)
        a, b, s = (np.concatenate(x) for x in zip(*out))
        return lists(*best(a, b, s, k), p)

    return written(merged(placed.groupBy("tree", "pivot", "block").applyInArrow(run, LISTS), NEIGHBOURS, p), "lists")


def descend(nodes: DataFrame, state: DataFrame, dim: int, p: int, turn: int) -> DataFrame:
    """One round: neighbours of a node meet there, pairs with a new member are compared.  An entry is old
    once both its ends have met with it; others get their turn in later rounds."""
    rate = F.when(F.size("near") >= NEIGHBOURS, F.element_at("score", -1)).otherwise(F.lit(float("-inf")).cast("float"))
    edge = state.select("node", F.posexplode(F.arrays_zip("near", "old")).alias("place", "e"))
    # a node's best few, and the new entries wherever they stand
    edge = edge.where((F.col("place") < SAMPLE) | (~F.col("e.old") & (F.xxhash64("node", "e.near", F.lit(turn)) % 2 == 0)))
    edge = edge.select("node", F.col("e.near").alias("other"), F.col("e.old").alias("old"))
    back = edge.select(F.col("other").alias("node"), F.col("node").alias("other"), "old")
    few = Window.partitionBy("node").orderBy("old", F.xxhash64("node", "other", F.lit(turn)))
    back = back.withColumn("r", F.row_number().over(few)).where(F.col("r") <= SAMPLE).drop("r")
    meet = edge.unionByName(back).groupBy("node", "other").agg(F.min("old").alias("old"))
    held = state.select(F.col("node").alias("other"), rate.alias("least"))

    def half(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [r.tobytes() for r in matrix(batch.column("vec"), "<f4", dim).astype("<f2")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(raw, pa.binary())], ["other", "h"])

    vectors = nodes.select("node", "vec").mapInArrow(half, "other long, h binary").join(held, "other", "left")
    seen = meet.join(vectors, "other").select("node", "other", "old", "least", "h")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from rowmill.llm.ngram_join import runs

        a, b, s, size = [], [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            x = best(np.concatenate(a), np.concatenate(b), np.concatenate(s), NEIGHBOURS // 2)
            t = lists(*x, p)
            order = np.argsort(t.column("part").to_numpy(), kind="stable")
            yield from t.take(pa.array(order)).to_batches()

        for t in runs(batches, ["node"]):
            x = matrix(t.column("h"), "<f2", dim).astype(float)
            other, new = t.column("other").to_numpy(), ~t.column("old").to_numpy(zero_copy_only=False).astype(bool)
            least = t.column("least").fill_null(float("-inf")).to_numpy()
            score = (x @ x.T).astype(np.float32)  # summed in double precision: a pair scores the same wherever it meets
            ok = new[:, None] | new
            np.fill_diagonal(ok, False)
            i, j = np.nonzero(ok & (score > least[:, None]))
            a.append(other[i])
            b.append(other[j])
            s.append(score[i, j])
            size += len(i)
            if size > 2_000_000:
                yield from out()
                a, b, s, size = [], [], [], 0
        if size:
            yield from out()

    found = seen.repartition(max(p, parts(seen.sparkSession)), "node").sortWithinPartitions("node").mapInArrow(compare, LISTS)
    # what meets at both ends in this round is old from now on
    met = back.groupBy(F.col("other").alias("node")).agg(F.collect_list("node").alias("met"))
    old = F.transform(F.arrays_zip("near", "old"), lambda e: e["old"] | F.array_contains(F.coalesce("met", F.array().cast("array<long>")), e["near"]))
    before = state.join(met, "node", "left").withColumn("old", old).select(*state.columns)
    return written(merged(before.unionByName(found), NEIGHBOURS, p), "lists")


def graph_of(state: DataFrame) -> DataFrame:
    """(part, node, near): a node's neighbours and as many of those that have it as neighbour."""
    edge = state.select("node", F.explode("near").alias("other"))
    few = Window.partitionBy("other").orderBy(F.xxhash64("node", "other"))
    back = edge.withColumn("r", F.row_number().over(few)).where(F.col("r") <= NEIGHBOURS).groupBy(F.col("other").alias("node")).agg(F.collect_list("node").alias("back"))
    both = state.join(back, "node", "left")
    return both.select("part", "node", F.array_union("near", F.coalesce("back", F.array().cast("array<long>"))).alias("near"))


class Index:
    """A stored graph over stored nodes, with their cells; ``updates``: the share of entries each round changed."""

    def __init__(self, spark: SparkSession, nodes: DataFrame, graph: DataFrame, cells: Cells, wide: int, p: int, updates: list[float]):
        self.spark, self.nodes, self.graph, self.cells, self.wide, self.p = spark, nodes, graph, cells, wide, p
        self.updates = updates


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of rows that aren't zero; no square overflows or vanishes."""
    most = np.abs(x).max(1, initial=0.0)
    y = x / np.where(most > 0, most, 1.0)[:, None]
    return np.minimum(most * np.sqrt((y * y).sum(1)), np.finfo(float).max / 4)


def points_of(emb: DataFrame, k: int) -> tuple[DataFrame, int]:
    """(v, ids, norm) of different vectors, stored, and their width; each keeps its k + 1 smallest ids."""
    wide = width(emb)
    own = packed(usable(emb).where(F.exists("embedding", lambda x: x != 0)), wide, "<f8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("ids"), pa.array(norms(matrix(batch.column("v"), "<f8", wide)))], ["v", "ids", "norm"])

    return written(distinct(own, k + 1).mapInArrow(run, "v binary, ids array<long>, norm double"), "points"), wide


def build(emb: DataFrame, k: int = 20, tolerance: float = TOLERANCE) -> Index | None:
    """One index of all usable rows; None if empty."""
    points, wide = points_of(emb, k)
    top, n = points.agg(F.max("norm"), F.count(F.lit(1))).first()
    return index_of(points, wide, top, n, tolerance) if n else None


def build_classes(emb: DataFrame, k: int = 20, tolerance: float = TOLERANCE) -> list[Index]:
    """An index for each class of norms that has rows, at most ``CLASSES``."""
    points, wide = points_of(emb, k)
    top = points.agg(F.max("norm")).first()[0]
    if top is None:
        return []
    place = F.least(F.lit(CLASSES - 1), F.floor(F.log2(F.lit(top) / F.col("norm")))).cast("int")
    classed = points.withColumn("class", place)
    found = classed.groupBy("class").agg(F.max("norm").alias("top"), F.count(F.lit(1)).alias("n")).orderBy("class").collect()
    return [index_of(classed.where(F.col("class") == r["class"]).drop("class"), wide, r["top"], r["n"], tolerance) for r in found]


def index_of(points: DataFrame, wide: int, top: float, n: int, tolerance: float) -> Index:
    """Index of ``n`` points (v, ids, norm) whose largest norm is ``top``."""
    spark = points.sparkSession
    p = max(4, -(-n // PART))  # parts of one size at any scale, whatever the number of shuffle partitions
    nodes = nodes_of(points.drop("norm"), wide, top, p)
    cells = cells_of(nodes, wide + 1, n)
    state = first_lists(cells, wide + 1, p)
    updates: list[float] = []
    while n > BLOCK and (not updates or updates[-1] >= tolerance):  # one block has compared all with all
        was, state = state, descend(nodes, state, wide + 1, p, len(updates))
        both = state.select("node", "near").join(was.select("node", F.col("near").alias("was")), "node", "left")
        changed = both.agg(F.sum(F.size(F.array_except("near", F.coalesce("was", F.array().cast("array<long>")))))).first()[0]
        discard(was)
        updates.append((changed or 0) / (n * min(NEIGHBOURS, n - 1)))
    return Index(spark, nodes, written(graph_of(state), "graph"), cells, wide, p, updates)


BEAMS = "home int, q long, vec binary, beam array<long>, score array<float>, done array<boolean>"


def started(index: Index, queries: DataFrame) -> DataFrame:
    """Beams of the best seeds of the cells nearest to each query, and of those cells' pivots."""
    p, dim, cells = index.p, index.wide + 1, index.cells
    pivots = cells.pivots
    seeds = max(SEEDS, PIVOTS // cells.number)
    few = Window.partitionBy("tree", "pivot").orderBy(F.xxhash64("node", "tree"))
    entry = written(cells.keyed.withColumn("r", F.row_number().over(few)).where(F.col("r") <= seeds).drop("r"), "seeds")

    def lifted(batch: pa.RecordBatch) -> np.ndarray:
        v = matrix(batch.column("v"), "<f8", dim - 1)
        v = v / norms(v)[:, None]  # a query's length changes none of its orders
        return np.column_stack([v, np.zeros(len(v))]).astype("<f4")

    def beams(v: np.ndarray, q: np.ndarray, node: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        k = node.shape[1]
        ends = pa.array(np.arange(len(q) + 1, dtype=np.int32) * k)
        values = (pa.array(node.ravel()), pa.array(score.ravel().astype(np.float32)), pa.array(np.zeros(node.size, bool)))
        return pa.RecordBatch.from_arrays([pa.array((q % p).astype(np.int32)), pa.array(q), pa.array([r.tobytes() for r in v], pa.binary()), *(pa.ListArray.from_arrays(ends, x) for x in values)], ["home", "q", "vec", "beam", "score", "done"])

    def at_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, q = lifted(batch), batch.column("q").to_numpy()
            for name, x, group in pivots.value:
                near, s = nearest_pivots(v, x, group, PROBES)
                yield beams(v, q, name[near], s)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = lifted(batch)
            raw = pa.array([r.tobytes() for r in v], pa.binary())
            for t, (_, x, group) in enumerate(pivots.value):
                near = nearest_pivots(v, x, group, PROBES)[0]
                for k in range(near.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int32)), pa.array(near[:, k].astype(np.int32)), batch.column("q"), raw], ["tree", "pivot", "q", "vec"])

    def at_seeds(left: pa.Table, right: pa.Table) -> pa.Table:
        v, x, node = matrix(left.column("vec"), "<f4", dim), matrix(right.column("vec"), "<f4", dim), right.column("node").to_numpy()
        k = min(EXPAND // 4, len(node))
        s = v @ x.T
        top = np.argsort(-s, 1, kind="stable")[:, :k]
        return pa.Table.from_batches([beams(v, left.column("q").to_numpy(), node[top], np.take_along_axis(s, top, 1))])

    def join(t: pa.Table) -> pa.Table:
        q, (offset, node) = t.column("q").to_numpy(), unpack(t.column("beam"))
        name, first, row = np.unique(q, return_index=True, return_inverse=True)
        a, b, s, d = best(np.repeat(row, np.diff(offset)), node, unpack(t.column("score"))[1], EXPAND // 4)
        ends = pa.array(np.searchsorted(a, np.arange(len(name) + 1)), pa.int32())
        return pa.table([t.column("home").take(pa.array(first)), pa.array(name), t.column("vec").take(pa.array(first)), *(pa.ListArray.from_arrays(ends, pa.array(x)) for x in (b, s, d))], ["home", "q", "vec", "beam", "score", "done"])

    own = queries.select("q", "v")
    routed = own.mapInArrow(route, "tree int, pivot int, q long, vec binary")
    found = routed.groupBy("tree", "pivot").cogroup(entry.groupBy("tree", "pivot")).applyInArrow(at_seeds, BEAMS)
    return written(found.unionByName(own.mapInArrow(at_pivots, BEAMS)).groupBy("home").applyInArrow(join, BEAMS), "beams")


def search(index: Index, queries: DataFrame, beam: int = BEAM, expand: int = EXPAND) -> DataFrame:
    """(q, beam, score) for ``queries`` (q, v): greedy search until every node of every beam is expanded.
    It ends: a node has one score for a query, so beams only get better."""
    p, dim = index.p, index.wide + 1

    def open_nodes(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, node, place) of each query's best nodes not expanded."""
        offset, node = unpack(t.column("beam"))
        done = unpack(t.column("done"))[1].astype(bool)
        row = np.repeat(np.arange(t.num_rows), np.diff(offset))
        left = np.cumsum(~done)
        base = np.append(0, left)[offset[:-1]]
        ask = ~done & (left - base[row] <= expand)
        return row[ask], node[ask], np.flatnonzero(ask)

    def requests(row: np.ndarray, node: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows (part, query row) with their nodes, by part."""
        part = node % p
        order = np.lexsort((node, row, part))
        part, row, node = part[order], row[order], node[order]
        new = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (row[1:] != row[:-1])]) if len(part) else np.zeros(0, np.int64)
        return part[new].astype(np.int32), row[new], pa.ListArray.from_arrays(pa.array(np.append(new, len(node)), pa.int32()), pa.array(node))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            row, node, _ = open_nodes(t)
            q, home = batch.column("q").to_numpy(), batch.column("home").to_numpy()
            part, own, near = requests(row, node, q)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(home[own]), pa.array(q[own]), near], ["part", "home", "q", "nodes"])

    def follow(left: pa.Table, right: pa.Table) -> pa.Table:
        """Neighbours of the nodes asked for."""
        node = right.column("node").to_numpy()
        offset, near = unpack(right.column("near"))
        order = np.argsort(node)
        asked, wanted = unpack(left.column("nodes"))
        at = np.searchsorted(node[order], wanted)
        at = order[np.minimum(at, len(node) - 1)] if len(node) else np.zeros(0, np.int64)
        size = np.diff(offset)[at] if len(node) else np.zeros(0, np.int64)
        first = np.repeat(offset[:-1][at] - (np.cumsum(size) - size), size) if len(size) else np.zeros(0, np.int64)
        flat_near = near[first + np.arange(len(first))]
        ends = np.append(0, np.cumsum(size))[asked] if len(node) else np.zeros(len(asked), np.int64)
        return pa.table([left.column("home"), left.column("q"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat_near, pa.int64()))], ["home", "q", "nodes"])

    def score_requests(left: pa.Table, right: pa.Table) -> pa.Table:
        """What of the neighbours is new to each query's beam, by part, with the query."""
        names = ["part", "home", "q", "vec", "least", "nodes"]
        q = left.column("q").to_numpy()
        order = np.argsort(q)
        offset, found = unpack(right.column("nodes"))
        row = order[np.searchsorted(q[order], np.repeat(right.column("q").to_numpy(), np.diff(offset)))] if len(found) else np.zeros(0, np.int64)
        held_at, held = unpack(left.column("beam"))
        both_row = np.concatenate([np.repeat(np.arange(len(q)), np.diff(held_at)), row])
        both = np.concatenate([held, found])
        old = np.arange(len(both)) < len(held)
        order = np.lexsort((~old, both, both_row))
        both_row, both, old = both_row[order], both[order], old[order]
        one = np.r_[True, (both_row[1:] != both_row[:-1]) | (both[1:] != both[:-1])] if len(both) else old
        keep = one & ~old
        part, own, nodes = requests(both_row[keep], both[keep], q)
        score_at, score = unpack(left.column("score"))
        full = np.diff(score_at) >= beam
        least = np.where(full, score[np.maximum(score_at[1:] - 1, 0)] if len(score) else 0, -np.inf).astype(np.float32)
        return pa.table([pa.array(part), left.column("home").take(pa.array(own)), pa.array(q[own]), left.column("vec").take(pa.array(own)), pa.array(least[own]), nodes], names)

    def score_nodes(left: pa.Table, right: pa.Table) -> pa.Table:
        node = right.column("node").to_numpy()
        order = np.argsort(node)
        x = matrix(right.column("vec"), "<f4", dim)[order] if len(node) else np.zeros((0, dim), np.float32)
        offset, wanted = unpack(left.column("nodes"))
        at = np.searchsorted(node[order], wanted)
        v = matrix(left.column("vec"), "<f4", dim)
        least = left.column("least").to_numpy()
        sizes, keep, scores = [], [], []
        for k in range(left.num_rows):
            s = (x[at[offset[k] : offset[k + 1]]] * v[k]).sum(1)  # in the same order of sums for any set of nodes
            ok = np.flatnonzero(s > least[k])
            sizes.append(len(ok))
            keep.append(offset[k] + ok)
            scores.append(s[ok])
        ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        keep = np.concatenate(keep).astype(np.int64) if keep else np.zeros(0, np.int64)
        scores = np.concatenate(scores) if scores else np.zeros(0, np.float32)
        return pa.table([left.column("home"), left.column("q"), pa.ListArray.from_arrays(ends, pa.array(wanted[keep], pa.int64())), pa.ListArray.from_arrays(ends, pa.array(scores.astype(np.float32)))], ["home", "q", "nodes", "score"])

    def widen(left: pa.Table, right: pa.Table) -> pa.Table:
        """Mark what was expanded and merge what was found."""
        q = left.column("q").to_numpy()
        order = np.argsort(q)
        offset, node = unpack(left.column("beam"))
        score, done = unpack(left.column("score"))[1], unpack(left.column("done"))[1].astype(bool).copy()
        done[open_nodes(left)[2]] = True
        new_at, new = unpack(right.column("nodes"))
        row = order[np.searchsorted(q[order], np.repeat(right.column("q").to_numpy(), np.diff(new_at)))] if len(new) else np.zeros(0, np.int64)
        rows = np.concatenate([np.repeat(np.arange(len(q)), np.diff(offset)), row])
        a, b, s, d = best(rows, np.concatenate([node, new]), np.concatenate([score, unpack(right.column("score"))[1]]).astype(np.float32), beam, np.concatenate([done, np.zeros(len(new), bool)]))
        ends = pa.array(np.searchsorted(a, np.arange(len(q) + 1)), pa.int32())
        return pa.table([left.column("home"), left.column("q"), left.column("vec"), *(pa.ListArray.from_arrays(ends, pa.array(x)) for x in (b, s, d))], ["home", "q", "vec", "beam", "score", "done"])

    state = started(index, queries)
    while not state.where(F.exists("done", lambda x: ~x)).isEmpty():
        asked = state.mapInArrow(ask, "part int, home int, q long, nodes array<long>")
        near = asked.groupBy("part").cogroup(index.graph.groupBy("part")).applyInArrow(follow, "home int, q long, nodes array<long>")
        wanted = state.groupBy("home").cogroup(near.groupBy("home")).applyInArrow(score_requests, "part int, home int, q long, vec binary, least float, nodes array<long>")
        scored = wanted.groupBy("part").cogroup(index.nodes.select("part", "node", "vec").groupBy("part")).applyInArrow(score_nodes, "home int, q long, nodes array<long>, score array<float>")
        # a written table, whose size Spark knows: its estimate of a checkpoint's would grow with every round
        was, state = state, written(state.groupBy("home").cogroup(scored.groupBy("home")).applyInArrow(widen, BEAMS), "beams")
        discard(was)
    return state.select("q", "beam", "score")


def nearest(emb: DataFrame, queries: DataFrame, k: int = 20, tolerance: float = TOLERANCE, beam: int = BEAM, expand: int = EXPAND) -> DataFrame:
    """The k nearest found of each query, by inner product.

    ``emb`` and ``queries``: (vec_id, embedding).  Output: ``query_id``, ``rank`` from 1, ``vec_id``,
    ``score`` (inner product of the original vectors in double precision); ties go to the smaller vec_id.
    Rows without an id or a vector, zero vectors, and vectors with a component that is null or
    not finite take no part; shorter vectors count as padded with zeros; rows that share the query's
    vec_id are the query itself, and rows repeated whole count once.  Empty tables give no rows.
    """
    spark = emb.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    indexes = build_classes(emb, k, tolerance)
    if not indexes:
        return empty
    index_wide = indexes[0].wide
    asked = packed(usable(queries).where(F.exists("embedding", lambda x: x != 0)), index_wide, "<f8").distinct()
    asked = written(asked.withColumn("q", F.monotonically_increasing_id()), "queries")
    each = written(asked.groupBy("v").agg(F.min("q").alias("q")), "asked")

    def candidates(index: Index) -> DataFrame:
        found = search(index, each, max(beam, EXACT * k), expand)
        close = found.select("q", F.posexplode(F.slice("beam", 1, EXACT * k)).alias("place", "node")).select("q", "node")
        return close.join(index.nodes.select("node", F.col("v").alias("x"), "ids"), "node").select("q", "x", "ids")

    pairs = reduce(DataFrame.unionByName, map(candidates, indexes)).join(asked.select("q", "v"), "q")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = (matrix(batch.column("v"), "<f8", index_wide) * matrix(batch.column("x"), "<f8", index_wide)).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("ids"), pa.array(s)], ["v", "ids", "score"])

    scored = pairs.select("v", "x", "ids").mapInArrow(exact, "v binary, ids array<long>, score double")
    # every query of an equal vector gets the same candidates, but itself
    named = scored.join(asked.select("v", "q", F.col("vec_id").alias("query_id")), "v").select("q", "query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id != query_id")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

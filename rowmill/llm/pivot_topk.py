"""Exact top-k inner products over a pivot-distance index.

Integer vectors x get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, queries
a zero; the largest inner products then belong to the nearest points.  Every vector is
keyed by its nearest pivot and its distance to it and the keys are sorted in ranges, cut
into annuli of a bounded number of vectors.  The annulus around each query's own key gives a
first bound.  By the triangle inequality only annuli whose distances lie within the bound
of the query's own distance to the pivot can hold better ones; in each, the search
widens from there and stops as its bound closes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.common import parts, some_rows, written
from rowmill.llm.vectors import distinct, matrix, packed, unpack, usable, width

SCALE = 1024
PIVOTS = 64
SAMPLE = 4096
ANNULUS = 2048
STEP = 256
#: So many annuli's bounds (32 bytes each) are broadcast; beyond that queries and annuli are joined by pivot.
BOUNDS = 1_000_000


def choose_pivots(sample: np.ndarray, number: int) -> np.ndarray:
    """Centres of a bounded sample: spread seeds, then a few rounds of k-means."""
    rng = np.random.default_rng(11)
    centre = sample[rng.choice(len(sample), min(number, len(sample)), replace=False)]
    for _ in range(5):
        gap = (centre * centre).sum(1) - 2 * sample @ centre.T
        own = gap.argmin(1)
        centre = np.stack([sample[own == k].mean(0) if (own == k).any() else centre[k] for k in range(len(centre))])
    return centre


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Points with the additional coordinate; top: M^2."""
    x = x.astype(float)
    return np.column_stack([x, np.sqrt(np.maximum(0.0, top - (x * x).sum(1)))])


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)))


class Space:
    """What all tasks know: width, M^2 and the pivots (a bounded number)."""

    def __init__(self, wide: int, top: float, pivots: np.ndarray):
        self.wide, self.top, self.pivots = wide, top, pivots

    def slack(self) -> float:
        """More than the distances' rounding."""
        return 1e-6 * np.sqrt(self.top + 1)

    def radius(self, norm2: float, bound: float) -> float:
        """Distance within which a point's inner product reaches ``bound``."""
        return np.sqrt(max(0.0, norm2 + self.top - 2 * bound)) + self.slack()


def build_index(points: DataFrame, space) -> DataFrame:
    """Annuli (pivot, near, far, ids, v, d) of distinct vectors (v, ids); one row each."""
    spark = points.sparkSession

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = space.value
        for batch in batches:
            d = distances(lifted(matrix(batch.column("v"), "<i8", own.wide), own.top), own.pivots)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), batch.column("v"), batch.column("ids")], ["pivot", "d", "v", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def annulus() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            d = t.column("d").to_numpy()
            return pa.RecordBatch.from_arrays(
                [pa.array([t.column("pivot")[0].as_py()], pa.int32()), pa.array([d[0]]), pa.array([d[-1]]), pa.array([t.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))), pa.array([b"".join(t.column("v").to_pylist())], pa.binary()), pa.array([d.tobytes()], pa.binary())],
                ["pivot", "near", "far", "ids", "v", "d"],
            )

        size, last = 0, None
        for batch in batches:
            pivot = batch.column("pivot").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(pivot)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                while a < b:
                    if held and (pivot[a] != last or size >= ANNULUS):
                        yield annulus()
                        held, size = [], 0
                    last = pivot[a]
                    n = min(b - a, ANNULUS - size)
                    held.append(batch.slice(a, n))
                    size, a = size + n, a + n
        if held:
            yield annulus()

    keyed = written(points.mapInArrow(key, "pivot int, d double, v binary, ids array<long>"), "keyed")
    ranged = keyed.repartitionByRange(parts(spark), "pivot", "d").sortWithinPartitions("pivot", "d")
    index = ranged.mapInArrow(cut, "pivot int, near double, far double, ids array<array<long>>, v binary, d binary")
    return written(index.withColumn("annulus", F.monotonically_increasing_id()), "annuli")


def probe(pairs: DataFrame, index: DataFrame, space, k: int) -> DataFrame:
    """(q, score, ids): the k + 1 best vectors of each pair (place, q, v, dq, bound); place: an annulus."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = space.value
        out_q, out_s, out_ids = [], [], []
        if left.num_rows and right.num_rows:
            d = np.frombuffer(right.column("d")[0].as_py(), float)
            x = np.frombuffer(right.column("v")[0].as_py(), "<i8").reshape(len(d), own.wide)
            exact = own.top < 2**52  # then all inner products fit doubles, and their sums are exact
            x = x.astype(float) if exact else x
            ids = right.column("ids")[0].values
            first = np.array([i[0] for i in ids.to_pylist()])
            queries = matrix(left.column("v"), "<i8", own.wide)
            for q, v, dq, bound in zip(left.column("q").to_pylist(), queries, left.column("dq").to_pylist(), left.column("bound").to_pylist()):
                n2 = float((v.astype(float) ** 2).sum())
                v = v.astype(float) if exact else v
                best = np.zeros(0, np.int64)
                score = np.zeros(0, x.dtype)
                at = int(np.searchsorted(d, dq))
                a = b = at
                low = -np.inf if bound is None else float(bound)
                while True:
                    r = own.radius(n2, low) if low > -np.inf else np.inf
                    left_ok = a > 0 and d[a - 1] >= dq - r
                    right_ok = b < len(d) and d[b] <= dq + r
                    if not left_ok and not right_ok:
                        break
                    rows = []
                    if left_ok:
                        rows.append(np.arange(max(0, a - STEP), a))
                        a = max(0, a - STEP)
                    if right_ok:
                        rows.append(np.arange(b, min(len(d), b + STEP)))
                        b = min(len(d), b + STEP)
                    rows = np.concatenate(rows)
                    best = np.append(best, rows)
                    score = np.append(score, x[rows] @ v)
                    order = np.lexsort((first[best], -score))[: k + 1]
                    best, score = best[order], score[order]
                    if len(best) == k + 1:
                        low = max(low, float(score[-1]))
                keep = score >= low if bound is not None else np.ones(len(best), bool)
                out_q += [q] * int(keep.sum())
                out_s += score[keep].astype(np.int64).tolist()
                out_ids += best[keep].tolist()
            taken = ids.take(pa.array(out_ids, pa.int64()))
        else:
            taken = pa.array([], pa.list_(pa.int64()))
        return pa.table({"q": pa.array(out_q, pa.int64()), "score": pa.array(out_s, pa.int64()), "ids": taken.cast(pa.list_(pa.int64()))})

    schema = "q long, score long, ids array<long>"
    return pairs.groupBy("place").cogroup(index.groupBy("annulus")).applyInArrow(run, schema)


class Bounds:
    """Places of the annuli of each pivot, with the distances they reach from and to, both ascending."""

    def __init__(self, rows: list, pivots: int):
        own: list[list[tuple]] = [[] for _ in range(pivots)]
        for r in sorted((r["pivot"], r["near"], r["far"], r["place"]) for r in rows):
            own[r[0]].append(r[1:])
        self.near, self.far = ([np.array([x[c] for x in o]) for o in own] for c in (0, 1))
        self.place = [np.array([x[2] for x in o], np.int64) for o in own]

    def homes(self, dq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, pivot) of the annulus nearest to each row's own distances to the pivots."""
        best = np.full(len(dq), np.inf)
        place, pivot = np.zeros(len(dq), np.int64), np.zeros(len(dq), np.int64)
        tie = np.full(len(dq), np.inf)
        for p, (near, far, own) in enumerate(zip(self.near, self.far, self.place)):
            if len(own):
                at = np.maximum(np.searchsorted(near, dq[:, p], "right") - 1, 0)
                for k in (at, np.minimum(at + 1, len(own) - 1)):
                    gap = np.maximum(0.0, np.maximum(near[k] - dq[:, p], dq[:, p] - far[k]))
                    closer = (gap < best) | ((gap == best) & (dq[:, p] < tie))
                    best, tie = np.where(closer, gap, best), np.where(closer, dq[:, p], tie)
                    place, pivot = np.where(closer, own[k], place), np.where(closer, p, pivot)
        return place, pivot

    def within(self, dq: np.ndarray, r: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(pivot, rows, places): the annuli that reach within ``r`` of each row's distance to a pivot."""
        for p, (near, far, own) in enumerate(zip(self.near, self.far, self.place)):
            lo = np.searchsorted(far, dq[:, p] - r)
            size = np.maximum(0, np.searchsorted(near, dq[:, p] + r, "right") - lo)
            if size.any():
                row = np.repeat(np.arange(len(dq)), size)
                yield p, row, own[np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)]


def distances_of(batch: pa.RecordBatch) -> np.ndarray:
    return unpack(batch.column("far"))[1].reshape(batch.num_rows, -1)


def shared_homes(shared):
    """Each query at its first annulus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                dq = distances_of(batch)
                place, pivot = shared.value.homes(dq)
                yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("q"), batch.column("v"), batch.column("n2"), pa.array(dq[np.arange(len(dq)), pivot])], ["place", "q", "v", "n2", "dq"])

    return run


def shared_reach(shared, space):
    """Each query at every annulus that may hold something better than its bound; others are never paired with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                dq, n2 = distances_of(batch), batch.column("n2").to_numpy()
                bound = batch.column("bound").cast(pa.float64()).fill_null(-np.inf).to_numpy()
                r = np.where(np.isfinite(bound), np.sqrt(np.maximum(0.0, n2 + space.value.top - 2 * np.where(np.isfinite(bound), bound, 0.0))) + space.value.slack(), np.inf)
                for p, row, place in shared.value.within(dq, r):
                    for at in range(0, len(row), 20_000):
                        k = pa.array(row[at : at + 20_000])
                        yield pa.RecordBatch.from_arrays([pa.array(place[at : at + 20_000]), *(batch.column(c).take(k) for c in ("q", "v")), pa.array(dq[row[at : at + 20_000], p]), batch.column("bound").take(k)], ["place", "q", "v", "dq", "bound"])

    return run


def search(emb: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE) -> DataFrame:
    """The k largest integer inner products of each query.

    ``emb`` and ``queries``: (vec_id, embedding); components become floor(scale * x).  Output:
    ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; ties go to the smaller vec_id; fewer rows if there
    are fewer candidates.  Rows without an id, a vector, or with a component that is null or not finite
    take no part; shorter vectors count as padded with zeros; rows that share the query's vec_id
    are the query itself, and rows repeated whole count once.  Empty tables give no rows.  Scores are
    exact longs; vectors so long that one might not fit (a squared norm of 2^62 and more) raise an
    OverflowError, as a sum of longs does in SQL.
    """
    spark = emb.sparkSession
    wide = width(emb)
    rows = packed(usable(emb), wide, "<i8", scale)
    points = written(distinct(rows, k + 1), "points")
    every_query = written(packed(usable(queries), wide, "<i8", scale).distinct(), "queries")
    # equal queries are searched once
    asked = written(every_query.select("v").distinct().withColumn("q", F.monotonically_increasing_id()), "asked")

    def norm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), "<i8", wide).astype(float)
            yield pa.RecordBatch.from_arrays([pa.array([float((x * x).sum(1).max())] if len(x) else [], pa.float64())], ["n"])

    every = points.select("v").unionByName(asked.select("v"))
    top = every.mapInArrow(norm, "n double").agg(F.max("n")).first()[0]
    taken = [bytes(r["v"]) for r in some_rows(points.select("v"), SAMPLE, F.xxhash64("v")).collect()]
    if top is not None and top >= 2.0**62:
        raise OverflowError(f"inner products up to {top:.3g} don't fit a long")
    if top is None or not taken:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = lifted(np.frombuffer(b"".join(taken), "<i8").reshape(len(taken), wide), top)
    space = spark.sparkContext.broadcast(Space(wide, top, choose_pivots(sample, PIVOTS)))
    index = build_index(points, space)

    def to_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), "<i8", wide).astype(float)
            d = distances(np.column_stack([x, np.zeros(len(x))]), space.value.pivots)
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("v"), pa.array((x * x).sum(1)), pa.array(list(d), pa.list_(pa.float64()))], ["q", "v", "n2", "far"])

    keyed = asked.select("q", "v").mapInArrow(to_pivots, "q long, v binary, n2 double, far array<double>")
    keyed = written(keyed, "keyed_queries")
    bounds = index.select(F.col("annulus").alias("place"), "pivot", "near", "far")
    near_all = None
    if bounds.count() <= BOUNDS:
        shared = spark.sparkContext.broadcast(Bounds(bounds.collect(), len(space.value.pivots)))
        home = keyed.mapInArrow(shared_homes(shared), "place long, q long, v binary, n2 double, dq double")
    else:
        by_pivot = keyed.select("q", "v", "n2", F.posexplode("far").alias("pivot", "dq"))
        gap = F.greatest(F.col("near") - F.col("dq"), F.col("dq") - F.col("far"), F.lit(0.0))
        near_all = written(by_pivot, "by_pivot").join(bounds, "pivot").withColumn("gap", gap)
        # first bound: the annulus nearest to the query's own key, of a pivot that has any
        home = near_all.groupBy("q").agg(F.min_by(F.struct("place", "v", "n2", "dq"), F.struct("gap", "dq", "place")).alias("s")).select("q", "s.*")
    start = probe(home.withColumn("bound", F.lit(None).cast("long")), index, space, k)
    worst = Window.partitionBy("q").orderBy(F.desc("score"))
    # the (k + 1)-th best so far: the query itself may be one of them
    bound = start.withColumn("r", F.row_number().over(worst)).where(F.col("r") == k + 1).select("q", F.col("score").alias("bound"))
    bound = written(bound, "bounds")
    if near_all is None:
        near = keyed.join(bound, "q", "left").mapInArrow(shared_reach(shared, space), "place long, q long, v binary, dq double, bound long")
    else:
        radius = F.sqrt(F.greatest(F.lit(0.0), F.col("n2") + F.lit(top) - 2 * F.col("bound"))) + F.lit(space.value.slack())
        near = near_all.join(bound, "q", "left").where(F.col("bound").isNull() | (F.col("gap") <= radius)).select("place", "q", "v", "dq", "bound")
    found = probe(near, index, space, k)
    # every query of an equal vector gets the same candidates, but itself
    named = every_query.select("v", F.monotonically_increasing_id().alias("own"), F.col("vec_id").alias("query_id")).join(asked, "v").select("q", "own", "query_id")
    all_ids = found.join(named, "q").select("own", "query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id != query_id")
    order = Window.partitionBy("own").orderBy(F.desc("score"), "vec_id")
    ranked = all_ids.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

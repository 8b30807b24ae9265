import numpy as np
import pytest

from rowmill.llm import nn_descent as A
from rowmill.llm import pivot_topk as E

SCHEMA = "vec_id long, embedding array<float>, label int, v string, ids int, node string, q string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if c is None else float(c) for c in x], 1, "v", 2, "n", "q", 3) for i, x in rows], SCHEMA).repartition(4)


def usable(x):
    return x is not None and all(c is not None and np.isfinite(c) for c in x)


def padded(rows):
    wide = max([len(x) for _, x in rows if usable(x)], default=0)
    return [(i, np.array([*map(np.float32, x), *[0] * (wide - len(x))], float)) for i, x in rows if i is not None and usable(x)]


def brute(rows, step, k, value):
    own = padded(rows)
    out = []
    for q, x in own:
        if q % step == 0:
            best = sorted(((-value(x, y), i) for i, y in own if i != q))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def integer(x, y):
    return int(np.floor(1024 * x) @ np.floor(1024 * y))


def edge_rows():
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=6)) for k in range(150)]
    rows += [(200 + k, rows[20][1]) for k in range(40)]  # one very common vector
    rows += [(300, None), (301, [None, 1, 2, 3, 4, 5]), (302, [np.nan] * 6), (303, [np.inf] + [0] * 5), (304, [1, 2, 3]), (305, []), (None, rows[1][1]), (306, [0] * 6), (307, -rows[3][1]), (400, [0.5] * 6), (500, [0.5] * 6)]
    return [(i, x if x is None else list(x)) for i, x in rows]


def test_exact_search_on_edges(spark, monkeypatch):
    rows = edge_rows()
    emb = frame(spark, rows)
    queries = emb.where("vec_id % 20 = 0")
    want = brute(rows, 20, 10, integer)
    assert sorted(map(tuple, E.search(emb, queries).collect())) == want
    monkeypatch.setattr(E, "ANNULUS", 16)  # many annuli, small steps
    monkeypatch.setattr(E, "STEP", 3)
    assert sorted(map(tuple, E.search(emb, queries).collect())) == want
    monkeypatch.setattr(E, "BOUNDS", 0)  # too many to broadcast: joined by pivot
    assert sorted(map(tuple, E.search(emb, queries).collect())) == want


def test_exact_search_in_clusters(spark, monkeypatch):
    monkeypatch.setattr(E, "ANNULUS", 64)
    monkeypatch.setattr(E, "STEP", 8)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16)) * 3
    rows = [(k, list(centres[k % 12] + rng.normal(size=16) * 0.05)) for k in range(1500)]
    emb = frame(spark, rows)
    assert sorted(map(tuple, E.search(emb, emb.where("vec_id % 100 = 0")).collect())) == brute(rows, 100, 10, integer)


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (3, [0.5, 0.5])]
    emb = frame(spark, rows)
    assert sorted(map(tuple, E.search(emb, emb).collect())) == brute(rows, 1, 10, integer)
    got = A.nearest(emb, emb)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()) == [(q, r, i) for q, r, i, _ in brute(rows, 1, 20, lambda x, y: float(x @ y))]
    for f in (E.search, A.nearest):
        assert f(emb.limit(0), emb.limit(0)).collect() == []
        assert f(emb, emb.limit(0)).collect() == []


def recall(spark, rows, got, step, k=20):
    own = [(i, x) for i, x in padded(rows) if x.any()]
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append(r)
    hit = total = 0
    for q, r, i, s in brute([(i, list(x)) for i, x in own], step, k, lambda x, y: float(x @ y)):
        hit += any(x["vec_id"] == i for x in found.get(q, ()))
        total += 1
    vec = dict(own)
    for q, mine in found.items():
        mine.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1)) and q not in {r["vec_id"] for r in mine}
        assert all(abs(r["score"] - vec[q] @ vec[r["vec_id"]]) < 1e-9 for r in mine)
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
    return hit / total


def test_approximate_search_on_edges(spark):
    rows = edge_rows()
    emb = frame(spark, rows)
    got = A.nearest(emb, emb.where("vec_id % 20 = 0")).collect()
    assert recall(spark, rows, got, 20) == 1.0  # one block: the lists are exact
    assert 306 not in {r["vec_id"] for r in got} | {r["query_id"] for r in got}  # zero vectors take no part


@pytest.mark.parametrize("clustered", [False, True])
def test_descent_and_greedy_search_find_most(spark, monkeypatch, clustered):
    monkeypatch.setattr(A, "BLOCK", 200)  # several blocks, so that rounds and search matter
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2500, 12))
    if clustered:
        x = rng.normal(size=(25, 12))[rng.integers(0, 25, 2500)] + 0.1 * x
    rows = [(k, list(v)) for k, v in enumerate(x)]
    emb = frame(spark, rows)
    got = A.nearest(emb, emb.where("vec_id % 50 = 0"), beam=96, expand=24).collect()
    assert recall(spark, rows, got, 50) >= 0.95


def test_search_goes_on_until_beams_are_expanded(spark, monkeypatch):
    monkeypatch.setattr(A, "PIVOTS", 1)
    monkeypatch.setattr(A, "SEEDS", 1, raising=False)
    a = np.linspace(0, 3, 400)  # an arc: every step towards a query is short, and the only seed is far from most
    rows = [(k, [np.cos(x), np.sin(x)]) for k, x in enumerate(a)]
    emb = frame(spark, rows)
    got = A.nearest(emb, emb.where("vec_id % 50 = 0")).collect()
    assert recall(spark, rows, got, 50) >= 0.99


def test_search_reaches_clusters_beyond_the_number_of_pivots(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 200)
    monkeypatch.setattr(A, "PIVOTS", 4)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 12))[np.arange(2500) % 50] + 0.01 * rng.normal(size=(2500, 12))
    rows = [(k, list(v)) for k, v in enumerate(x)]
    emb = frame(spark, rows)
    got = A.nearest(emb, emb.where("vec_id % 49 = 0"), beam=96, expand=24).collect()
    assert recall(spark, rows, got, 49) >= 0.95


def test_descent_converges(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 64)
    monkeypatch.setattr(A, "PIVOTS", 4)  # far fewer than cells: pivots are looked up by group
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2500, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    emb = frame(spark, [(k, list(v)) for k, v in enumerate(x)])
    index = A.build(emb)
    name = {r["node"]: r["ids"][0] for r in index.nodes.collect()}
    x = x.astype(np.float32)
    hit = 0
    for r in index.graph.collect():
        k = name[r["node"]]
        s = x @ x[k]
        s[k] = -np.inf
        hit += len({name[b] for b in r["near"]} & set(np.argsort(-s)[:20].tolist()))
    assert hit / 50_000 >= 0.99
    assert index.updates[-1] < A.TOLERANCE <= min(index.updates[:-1])


def test_rows_repeated_whole_count_once(spark):
    """Thirty copies of a row push no other vec_id out."""
    x = [0.3, -0.2, 0.9]
    rows = [(5, x)] * 30 + [(k, x) for k in range(6, 40)] + [(100, [1.0, 0.5, 0.25])] * 3 + [(41, [0.9, 0.1, 0.2])]
    emb = frame(spark, rows)
    once = list({(i, tuple(v)) for i, v in rows})
    want = brute([(i, list(v)) for i, v in once], 100, 10, integer)
    assert sorted(map(tuple, E.search(emb, emb.where("vec_id = 100")).collect())) == want and len(want) == 10
    got = sorted(map(tuple, A.nearest(emb, emb.where("vec_id = 100")).collect()))
    near = brute([(i, list(v)) for i, v in once], 100, 20, lambda a, b: float(a @ b))
    assert [r[:3] for r in got] == [r[:3] for r in near] and len(got) == 20


def test_the_sql_of_the_exact_search_agrees_on_repeated_rows(spark, tmp_path):
    import duckdb

    from rowmill.llm import registry
    rng = np.random.default_rng(1)
    rows = [(k % 130, list(rng.normal(size=4).round(1))) for k in range(260)] + [(100, [0.5] * 4)] * 4 + [(7, [0.25] * 4)] * 4
    path = str(tmp_path / "embeddings.parquet")
    frame(spark, rows).select("vec_id", "embedding").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{path}/*.parquet')")
    want = sorted(con.execute(registry.ORACLE["op10_pivot_topk"]).fetchall())
    assert sorted(map(tuple, registry.op10_pivot_topk(spark, str(tmp_path)).collect())) == want


@pytest.mark.parametrize("kind", ["outlier", "large", "small", "spread"])
def test_norms_of_any_size(spark, monkeypatch, kind):
    """One long vector, very long and very short ones, and norms over many magnitudes cost no recall."""
    monkeypatch.setattr(A, "BLOCK", 200)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 12))
    if kind == "outlier":
        x[777] *= 1e4
    x *= {"large": 1e30, "small": 1e-30}.get(kind, 1.0)
    if kind == "spread":
        x *= np.exp(rng.uniform(-2, 2, size=(900, 1)))
    rows = [(k, list(v)) for k, v in enumerate(x)]
    emb = frame(spark, rows)
    got = A.nearest(emb, emb.where("vec_id % 60 = 0"), beam=96, expand=24).collect()
    assert all(np.isfinite(r["score"]) for r in got)
    own = padded(rows)
    vec = dict(own)
    hit = 0
    found = {(r["query_id"], r["vec_id"]) for r in got}
    for q, _, i, _ in brute([(i, list(v)) for i, v in own], 60, 20, lambda a, b: float(a @ b)):
        hit += (q, i) in found
    assert len(vec) == 900 and hit / (15 * 20) >= 0.95


def test_class_edges(spark):
    """Huge and tiny components, alone or together, neither overflow nor vanish."""
    rows = [(0, [1e300, 1e300]), (20, [1e-300, 2e-300]), (1, [1.0, 1.0]), (2, [-1.0, 2.0]), (3, [3e-200, 1e-200]), (40, [1.0, 0.0])]
    emb = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in A.nearest(emb, emb.where("vec_id % 20 = 0")).collect()}
    assert got[40, 1] == 0 and got[40, 2] == 1 and len(got) == 15


def test_more_nodes_than_cells_hold(spark, monkeypatch):
    """Cells many times a block are cut by a hash; the descent makes up for it."""
    monkeypatch.setattr(A, "BLOCK", 100)
    monkeypatch.setattr(A, "CELLS", 3)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(30, 12))[rng.integers(0, 30, 2000)] + 0.1 * rng.normal(size=(2000, 12))
    rows = [(k, list(v)) for k, v in enumerate(x)]
    emb = frame(spark, rows)
    assert recall(spark, rows, A.nearest(emb, emb.where("vec_id % 50 = 0"), beam=96, expand=24).collect(), 50) >= 0.95


@pytest.mark.parametrize("x", [1e300, -1e300, 5e15, 3e6])
def test_scores_that_fit_no_long_are_refused(spark, x):
    emb = spark.createDataFrame([(0, [1.0, 2.0]), (100, [x, 1.0]), (3, [0.5, 0.25])], "vec_id long, embedding array<double>")
    with pytest.raises(OverflowError, match="fit a long"):
        E.search(emb, emb.where("vec_id % 100 = 0"))
    near = [(0, [1.0, 2.0]), (100, [1.5e6, 1.0]), (3, [0.5, 0.25])]
    emb = spark.createDataFrame(near, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, E.search(emb, emb.where("vec_id % 100 = 0")).collect())) == brute(near, 100, 10, lambda a, b: int(np.floor(1024 * a).astype(int) @ np.floor(1024 * b).astype(int)))

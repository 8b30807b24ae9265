import random
import zlib

import numpy as np

from rowmill.llm import langid as G
from tests.llm.cases import edge_docs, edge_rows, empty_docs

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = G.identify(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.98


def test_held_out_langs_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    other = docs.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 4 = 2 then 'xx' else lang end as lang")
    a, b = (sorted(map(tuple, G.identify(x).collect())) for x in (docs, other))
    assert a == b


def test_edges(spark):
    out = G.identify(edge_docs(spark)).collect()
    assert len(out) == len(edge_rows())
    none = {i for i, t in edge_rows() if not any(c.isalpha() for c in t or "")}
    assert none >= {5, 6, 7, 11}
    for r in out:
        if r["doc_id"] in none - {None}:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] == "en" and 0 <= r["score"] <= 1
    unlabelled = edge_docs(spark).withColumn("lang", G.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in G.identify(unlabelled).collect()} == {"und"}
    assert G.identify(empty_docs(spark)).collect() == []


def test_grams_equal_a_plain_loop():
    for text in ("Ab, cé!", "x", "  ÄÖ  9", "日本 b"):
        low = "".join(c if c.isalpha() else " " for c in text.lower())
        low = f" {low} "
        want = []
        for n in (1, 2, 3):
            for k in range(len(low) - n + 1):
                h = ord(low[k])
                for c in low[k + 1 : k + n]:
                    h = (h * 0x01000193 & 0xFFFFFFFF) ^ ord(c)
                want.append(((h + n - 1) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - G.BITS))
        assert sorted(G.grams(text).tolist()) == sorted(want)
    assert G.grams("12 !") is None


def test_regularised_weights_are_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    rows = []
    for k in range(400):
        y = k % 2
        g = np.unique(rng.integers(0, 2000, 60))
        g = np.unique(np.append(g, 5000 + y)) if rng.random() < 0.9 else g
        rows.append((y, g, np.full(len(g), 1 / len(g))))
    m = G.Model(["a", "b"], np.ones(1 << G.BITS))
    m.fit(rows[:300], l1=0.02)
    assert (m.weight != 0).mean() < 0.05 and m.weight[5000, 0] > 0 > m.weight[5001, 0]
    m.calibrate(rows[300:])
    s = np.stack([x @ m.weight[g] + m.bias for _, g, x in rows[300:]])
    loss = lambda t: float(np.mean([np.log(np.exp(a / t - (a / t).max()).sum()) - (a / t - (a / t).max())[y] for a, (y, _, _) in zip(s, rows[300:])]))
    assert loss(m.temperature) <= min(loss(1.0), loss(5.0), loss(0.2)) + 1e-9


def test_rare_languages_are_classes(spark):
    rng = random.Random(6)
    en = "the river and old mill turn over quiet stones while bright birds sing near tall green trees".split()
    pl = "rzeka i stary młyn obracają ciche kamienie gdy jasne ptaki śpiewają blisko wysokich drzew zawsze".split()
    rows = [(k, " ".join(rng.choices(pl if k % 5000 == 1 else en, k=25)), "pl" if k % 5000 == 1 else "en") for k in range(60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    got = {r["doc_id"]: r["lang_pred"] for r in G.identify(docs).collect()}
    assert sum(lang == "pl" for _, _, lang in rows) == 12
    assert all(got[k] == lang for k, _, lang in rows if lang == "pl")
    assert sum(got[k] != lang for k, _, lang in rows) < 60


def plain_ftrl(rows, langs, epochs, alpha=2.0, beta=1.0, l1=1e-4, l2=1e-4):
    """The published update, one weight at a time."""
    z, n = {}, {}

    def weight(at):
        own = z.get(at, 0.0)
        return 0.0 if abs(own) <= l1 else -(own - np.sign(own) * l1) / ((beta + n.get(at, 0.0) ** 0.5) / alpha + l2)

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            y, features, x = rows[k]
            features, x = [*features, -1], [*x, 1.0]
            s = [sum(v * weight((f, c)) for f, v in zip(features, x)) for c in range(langs)]
            p = np.exp(np.array(s) - max(s))
            p /= p.sum()
            steps = []
            for f, v in zip(features, x):
                for c in range(langs):
                    g = v * (p[c] - (c == y))
                    sigma = ((n.get((f, c), 0.0) + g * g) ** 0.5 - n.get((f, c), 0.0) ** 0.5) / alpha
                    steps.append(((f, c), g - sigma * weight((f, c)), g * g))
            for at, dz, dn in steps:
                z[at], n[at] = z.get(at, 0.0) + dz, n.get(at, 0.0) + dn
    return weight


def test_weights_equal_a_plain_trainer():
    rng = np.random.default_rng(5)
    rows = []
    for k in range(25):
        g = np.unique(rng.integers(0, 40, 8))
        rows.append((k % 3, g.astype(np.int64), rng.random(len(g)) * (1 + (g % 3 == k % 3))))
    model = G.Model(["a", "b", "c"], np.ones(1 << G.BITS))
    model.fit(rows, epochs=3)
    weight = plain_ftrl(rows, 3, 3)
    for f in range(40):
        for c in range(3):
            assert abs(model.weight[f, c] - weight((f, c))) < 1e-5
    assert max(abs(model.bias[c] - weight((-1, c))) for c in range(3)) < 1e-9
    assert (model.weight[40:] == 0).all() and np.abs(model.weight).max() > 0.1

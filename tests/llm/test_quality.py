import zlib

import numpy as np

from rowmill.llm import quality as Q
from tests.llm.cases import edge_docs, edge_rows, empty_docs

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = Q.score_documents(docs, labels)
    rows = out.join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert out.count() == docs.count() and 40 < len(held) < 120
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.95
    assert np.mean([r["predicted"] for r in held if r["quality"] == 1]) >= 0.98
    kept = Q.keep_good(docs, labels)
    want = {r["doc_id"] for r in out.collect() if r["predicted"]}
    assert {r["doc_id"] for r in kept.collect()} == want and kept.columns == docs.columns


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality")
    a, b = (sorted(map(tuple, Q.score_documents(docs, x).collect())) for x in (labels, other))
    assert a == b


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (4, 1), (4, 1), (8, 1), (10, 0), (None, 1), (11, None), (13, 1)], "doc_id long, quality int")
    docs = edge_docs(spark)
    out = Q.score_documents(docs, labels).collect()
    assert len(out) == len(edge_rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    assert all(r["held_out"] is True for r in out if r["doc_id"] is None)
    none = Q.score_documents(docs, labels.where("quality = 7")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert Q.keep_good(docs, labels.limit(0)).count() == len(edge_rows())
    assert Q.score_documents(empty_docs(spark), labels).collect() == []
    assert Q.keep_good(docs, labels).columns == docs.columns


def test_risk_and_prior_on_a_known_mixture():
    rng = np.random.default_rng(1)
    good = rng.normal(0, 1, (4000, 2))
    free = np.concatenate([rng.normal(0, 1, (2800, 2)), rng.normal(4, 1, (1200, 2))])
    model, prior = Q.fit(good, free)
    assert abs(prior - 0.7) < 0.06
    test_good, test_bad = rng.normal(0, 1, (1000, 2)), rng.normal(4, 1, (1000, 2))
    assert (model.score(test_good) >= 0.3).mean() > 0.97 and (model.score(test_bad) < 0.3).mean() > 0.95
    assert (np.diff(model.posterior) >= 0).all()


def test_figures_read_the_whole_text():
    head = b"clean words in a plain line. " * 200
    assert Q.figures(head) != Q.figures(head + b"###" * 50)
    assert Q.figures(b"") == [0.0] * Q.FIGURES


def sigmoid_loss(z):
    return 1 / (1 + np.exp(z))


def test_descent_follows_the_non_negative_risk():
    """Steps equal those of a plain descent on numeric slopes of the published risk: when the part of the negatives
    falls below zero, the step goes up on that part alone."""
    rng = np.random.default_rng(3)
    for prior in (0.2, 0.6, 0.95):
        model = Q.Model(rng.normal(size=(300, 2)))
        good, free = (model.bins(rng.normal(shift, 1, size=(n, 2))) for shift, n in ((0.8, 60), (0.1, 90)))
        model.weight[:] = rng.normal(size=len(model.weight)) * 2
        w = np.append(model.weight.copy(), 0.3)
        model.bias = 0.3
        model.descend(good, free, prior, rounds=4)

        def parts(w):
            raw = lambda bins: w[:-1][bins].sum(1) + w[-1]
            positive = prior * sigmoid_loss(raw(good)).mean()
            return positive, sigmoid_loss(-raw(free)).mean() - prior * sigmoid_loss(-raw(good)).mean()

        m, v, turned = np.zeros(len(w)), np.zeros(len(w)), 0
        for t in range(1, 5):
            below = parts(w)[1] < 0
            turned += below
            goal = (lambda w: -parts(w)[1]) if below else (lambda w: sum(parts(w)))
            slope = np.array([(goal(w + e) - goal(w - e)) / 2e-6 for e in np.eye(len(w)) * 1e-6])
            slope[:-1] += 1e-4 * w[:-1]
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
            w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        seen = np.append(np.bincount(np.concatenate([good, free]).ravel(), minlength=len(w) - 1) > 0, True)
        assert np.abs(np.append(model.weight, model.bias) - w)[seen].max() < 1e-3
        assert turned == 0 or prior > 0.5

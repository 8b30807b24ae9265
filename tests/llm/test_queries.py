"""Registered queries against their SQL, and the pipeline against plain versions of its stages."""

import hashlib
import sys

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from rowmill.llm import pii, quality, registry
from tests.llm.cases import EXTRA, edge_docs, edge_rows, tuples
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_ngram_join import linked_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_its_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    want = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert tuples(df, *names) == sorted((tuple(r) for r in want.fetchall()), key=repr)


def test_every_operator_is_registered_once():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert E.queries()["pipeline"] is C.run and "pipeline" not in E.oracle_sql()
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "pii", "best_fit_packing"]


def test_nothing_else_imports_the_subpackage():
    import subprocess
    code = "import sys; import rowmill, rowmill.cli, rowmill.plans.registry, rowmill.streaming.split; assert not any('llm' in m for m in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=C.__file__.rsplit("/", 1)[0]).returncode == 0


def test_stages_keep_columns_and_take_effect(spark):
    docs = edge_docs(spark)
    stages = dict(C.STAGES)
    rows = tuples(docs, "doc_id", "text")

    good = stages["quality_classifier"](spark, docs, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(quality.shapes(quality.id_text(docs)), labels)
    assert good.columns == docs.columns
    if model is None:
        assert tuples(good, "doc_id", "text") == rows

    lines = stages["line_dedup"](spark, docs, SF)
    assert lines.columns == docs.columns
    got = sorted(((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in tuples(lines, "doc_id", "text")), key=repr)
    assert got == sorted(((i, sha) for i, _, _, sha in brute_lines(edge_rows())), key=repr)

    once = stages["ngram_jaccard_join"](spark, docs, SF)
    assert once.columns == docs.columns and set(EXTRA) < set(once.columns)
    assert once.count() == len(set(linked_rows(edge_rows())[0]))

    clean = stages["pii"](spark, docs, SF)
    assert tuples(clean, "doc_id", "text") == sorted(((i, None if t is None else pii.redacted(t)) for i, t in rows), key=repr)

    packed = stages["best_fit_packing"](spark, clean, SF)
    assert {r["doc_id"] for r in packed.collect()} == {i for i, _ in rows}


def test_run(spark):
    out = C.run(spark, "/root/testdata/sf0.01")
    rows = out.collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    kept = {r["doc_id"] for r in rows}
    assert kept < set(docs) and len(kept) > 0.6 * len(docs)
    texts = [docs[i]["text"] for i in kept]
    assert len(set(texts)) >= 0.98 * len(texts)  # copies are gone
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in bad) <= 0.1 * len(bad)
    fill = {}
    for r in rows:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048

import hashlib
from collections import defaultdict

import pytest

from rowmill.llm import line_dedup as L
from tests.llm.cases import edge_docs, edge_rows, empty_docs


def brute(rows, min_chars=20, min_docs=3):
    low = -(1 << 63)
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(strip))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(low if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or (low if i is None else i) == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", ["2", "8", "40"])
def test_edges_over_any_ranges(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = sorted((tuple(r) for r in L.line_report(edge_docs(spark)).collect()), key=repr)
        assert got == brute(edge_rows())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_line_of_most_documents_crosses_ranges(spark):
    line, rare = "a line that nearly every document holds", "a line that two documents hold, no more"
    rows = [(k, "\n".join([f"own text of document number {k}", line, line if k % 2 else "short", rare if k in (3, 7) else "x"])) for k in range(300)]
    rows += [(300 + k, line.upper()) for k in range(50)] + [(5, "another row of five\n" + line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        for n in (2, 3, 400):
            got = sorted((tuple(r) for r in L.line_report(docs, min_docs=n).collect()), key=repr)
            assert got == brute(rows, min_docs=n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bitmaps_and_text(spark):
    docs = edge_docs(spark)
    out = L.drop_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[23] == edge_rows()[[i for i, _ in edge_rows()].index(23)][1]  # the largest id keeps it
    assert text[22] == "" and text[21] == "second" and text[20] == "first own line of this one" and text[5] is None
    maps = L.keep_bitmaps(L.with_keys(docs.select("doc_id", "text"))).collect()
    assert all(list(L.keep(r["last"] + 1, r["keep"])) == [k for k in range(r["last"] + 1) if k in set(L.keep(r["last"] + 1, r["keep"]))] for r in maps)
    assert {r["doc"] for r in maps} >= {20, 21, 22}
    assert L.line_report(empty_docs(spark)).collect() == [] and L.drop_lines(empty_docs(spark)).collect() == []


def test_key():
    assert L.line_key(" \t\x0b ÄbC\x0c\r".encode()) == "Äbc".encode()
    assert L.counts("ä".encode() * 20, 20) and not L.counts("ä".encode() * 19, 20) and not L.counts(b"a" * 19, 20)

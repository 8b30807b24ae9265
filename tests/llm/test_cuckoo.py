"""Exact dedup: the filter and its buckets against sets, the index against plain grouping."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from rowmill.llm import cuckoo as C
from tests.llm.cases import edge_docs, edge_rows, empty_docs, tuples


def digest(text):
    return hashlib.sha256(re.sub("[ \t-\r]+", " ", text or "").encode()).digest()


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(digest(text), []).append(doc)
    out = []
    for d, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        out += [(i, ids[0], len(ids), k == 0, d.hex()) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def test_filter_never_misses_a_live_digest():
    rng = random.Random(1)
    bucket, live = C.Bucket(None, {}), {}
    for step in range(20_000):
        d = hashlib.sha256(b"%d" % rng.randrange(6000)).digest()
        if rng.random() < 0.6:
            bucket.add(d, step, step, 1)
            held = live.get(d)
            live[d] = (step, step, 1) if held is None else (*held[:2], held[2] + 1)
        else:
            bucket.set(d, None, 0, 0)
            live.pop(d, None)
        assert bucket.find(d) == live.get(d)
    assert bucket.content == live and all(map(bucket.filter.may_hold, live))
    assert bucket.resized  # it outgrew its first size, from the stored keys
    assert sum(map(bool, sum(bucket.filter.table, []))) == len(live)  # deleted fingerprints are gone
    again = C.CuckooFilter.loads(bucket.filter.dumps())
    assert again.table == bucket.filter.table
    strange = [hashlib.sha256(b"s%d" % k).digest() for k in range(20_000)]
    assert sum(map(again.may_hold, strange)) < 40  # 8 of 65,536 a look-up at most


def test_false_hits_are_told_apart():
    """Digests with equal fingerprints in equal buckets are verified against the content."""
    a = bytes(8) + b"\x07\x00" + bytes(22)
    others = [bytes(8) + b"\x07\x00" + bytes(8) + bytes([k]) * 14 for k in range(1, 30)]
    bucket = C.Bucket(None, {})
    for k, d in enumerate([a, *others]):
        bucket.add(d, k, k, 1)
        if len(bucket.content) == 2 * C.SLOTS:
            break  # no filter of any size holds more equal marks
    assert bucket.verified == 2 * C.SLOTS - 1 and len(bucket.content) == 2 * C.SLOTS


def test_equals_brute_force(spark):
    assert tuples(C.dedup_report(edge_docs(spark))) == brute(edge_rows())
    assert C.dedup_report(empty_docs(spark)).collect() == []
    rows = edge_rows() + [(50, "a \t b"), (49, "a b"), (51, "a\n\n\x0bb"), (52, "a b"), (53, " a b"), (54, " " * 1_500_000), (55, "\n" * 1_500_000)]
    assert tuples(C.dedup_report(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_a_hot_text_and_overflowing_buckets(spark, monkeypatch):
    monkeypatch.setattr(C, "BUCKET_KEYS", 100)
    docs = spark.range(0, 9000, 1, 7).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 1, "same text").otherwise(F.concat(F.lit("text "), (F.col("id") % 4000).cast("string"))).alias("text"))
    index = C.DedupIndex.empty(spark).insert(docs)
    assert index.buckets == 90 and index.state.where("filter is not null").count() == 90
    assert tuples(index.report()) == brute([tuple(r) for r in docs.collect()])
    assert index.keys().agg(F.max("n")).first()[0] == 3000
    big = C.DedupIndex.empty(spark, 3)  # three buckets of some 1,400 keys: their filters are built anew
    monkeypatch.setattr(C, "BUCKET_KEYS", 10_000)
    monkeypatch.setattr(C, "parts", lambda _: 3)
    index = big.insert(docs)
    assert index.buckets == 3 and index.state.agg(F.min(F.when(F.col("filter").isNotNull(), F.col("uid")))).first()[0] > 0
    assert tuples(index.report()) == brute([tuple(r) for r in docs.collect()])


def test_insert_and_delete_in_batches(spark):
    rng = random.Random(2)
    rows = [(k, f"text {rng.randrange(60)}") for k in range(300)]
    frame = lambda x: spark.createDataFrame(x, "doc_id long, text string")
    index = C.DedupIndex.empty(spark)
    for at in (200, 0, 100):  # smaller ids may come later
        index = index.insert(frame(rows[at : at + 100]))
    assert tuples(index.report()) == brute(rows)
    gone = [r for r in rows if r[0] % 2 or r[1] == "text 7"]
    left = [r for r in rows if r not in gone]
    index = index.delete(frame(gone + [(1000, "never there"), (2, "text of another")]))
    assert tuples(index.report()) == brute(left)
    assert index.keys().count() == len({t for _, t in left}) and not index.keys().where(F.lower(F.hex("digest")) == digest("text 7").hex()).count()
    index = index.insert(frame([(5, "text 7"), (900, "text 7")]))  # comes back
    assert tuples(index.report()) == brute(left + [(5, "text 7"), (900, "text 7")])
    found = {r["doc_id"]: (r["keep_id"], r["n"]) for r in index.contains(frame([(1, "text  7"), (2, "none")])).collect()}
    assert found == {1: (5, 2), 2: (None, None)}

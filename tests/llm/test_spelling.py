"""Spelling variants against brute force: plain counting, and the edit distance of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowmill.llm import spelling as S
from tests.llm.cases import edge_docs, edge_rows, empty_docs, tuples


def brute_words(rows, min_chars=6, min_count=5):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_chars and n >= min_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=8), st.text("ab", max_size=9))
def test_one_edit(a, b):
    if 0 <= len(b) - len(a) <= 1:
        assert S.one_edit(a, b) == one_edit(a, b)


def brute(rows, ratio=5):
    n = brute_words(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {w: min(vs, key=lambda v: (-n[v], v)) if vs else None for w, vs in near.items()}
    form = {w: v if v is not None and n[v] >= ratio * n[w] else None for w, v in form.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n[w], len(near[w]), None if form[w] is None else n[form[w]]) for w in n), key=repr)


def test_long_words(spark, monkeypatch):
    monkeypatch.setattr(S, "LONG", 7)  # words of 8 characters and more are long, and one of 7 may meet one of 8
    want = brute(typed_rows())
    assert tuples(S.variants(spark.createDataFrame(typed_rows(), "doc_id long, text string"))) == want


def typed_rows():
    """Words in families one edit apart, in chains of rising counts, with accents, in texts of many words."""
    rng = random.Random(4)
    letters = "abcdeé"
    families = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 11))) for _ in range(25)]
    words = []
    for w in families:
        n = rng.choice([5, 8, 60])
        words += [w] * n
        for _ in range(rng.randrange(6)):
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])
            words += [v] * rng.choice([4, 5, 12, 300, 1500])
            w = v
    words += ["chaînon"] * 5 + ["chaînons"] * 30 + ["chaîons"] * 200
    rng.shuffle(words)
    texts = [" ".join(words[k : k + 97]) for k in range(0, len(words), 97)]
    return [(k * 7, t.title() if k % 3 else t + " ÷×÷×÷×") for k, t in enumerate(texts)]


@pytest.mark.parametrize("rows", [typed_rows(), edge_rows() * 3], ids=["families", "edges"])
def test_equals_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert tuples(S.variants(docs)) == want and want
    if len(want) > 30:
        assert any(r[1] for r in want) and any(r[2] != r[1] and r[1] for r in want)


def test_query_equals_brute_force_on_the_table(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert tuples(E.queries()["op12_spelling"](spark, sf)) == brute(rows)


def test_edges(spark):
    assert S.variants(empty_docs(spark)).collect() == []
    assert tuples(S.variants(edge_docs(spark))) == brute(edge_rows())
    with pytest.raises(ValueError):
        S.variants(empty_docs(spark), min_chars=4)
    long = "x" * 300_000
    rows = [(k, f"{long} {long[1:]}a") for k in range(5)]
    assert [r[3:] for r in tuples(S.variants(spark.createDataFrame(rows, "doc_id long, text string")))] == [(5, 1, None)] * 2


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=6, max_size=9), st.integers(0, 8), st.sampled_from("abc"), st.sampled_from("idr"), st.integers(0, 2**32 - 1))
def test_one_of_the_rarest_grams_is_shared(word, k, c, kind, seed):
    k %= len(word)
    other = {"i": word[:k] + c + word[k:], "d": word[:k] + word[k + 1 :], "r": word[:k] + c + word[k + 1 :]}[kind]
    if other == word or len(other) < 6:
        return
    rng = np.random.default_rng(seed)
    grams = sorted({s[p : p + q] for s in map(S.marked, (word, other)) for q in (2, 3, 4) for p in range(len(s) - q + 1)})
    own = S.GramDictionary([g for g in grams if rng.random() < 0.5], rng.integers(0, 3, S.SLOTS))
    lists = [{(side, at, g) for p, g in own.lists(w) for side, at in ((0, p), (1, len(w) - p))} for w in (word, other)]
    shared = lists[0] & lists[1]
    assert any(side == 0 for side, _, _ in shared) if len(word) == len(other) else shared

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowmill.llm import bpe as B
from rowmill.llm import packing as K
from rowmill.llm import token_scan as S
from tests.llm.cases import edge_docs, edge_rows, empty_docs, prose

POOL = [" ", "  ", "\n", "\t", "a", "B", "é", "1", "٣", "½", " ", "　", "\x1c", "\x85", "'s", "'", "don't", "<|endoftext|>", "<|", "日本", "!", "𝒳", "ﬀ", "​", "\r\n", "hello", "World", "x" * 70, "²", "Ⅷ", "_", "́", "न", "ि", "\x00", "﻿"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(B.default_path())


@pytest.fixture(scope="module")
def vocab():
    return B.Vocabulary(B.default_path())


def test_encoding_equals_the_library(library, vocab):
    rng = random.Random(1)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + [prose(k) for k in range(20)]
    words = sorted({w.encode() for t in texts[::2] for w in B.Encoder(vocab).split(t)})
    for enc in (B.Encoder(vocab), B.Encoder(vocab, B.Lexicon.build(words, vocab.merge(words)))):
        for at in range(0, len(texts), 500):
            part = texts[at : at + 500]
            for t, ids in zip(part, enc.encode(part)):
                want = library.encode(t, add_special_tokens=False).ids
                assert np.frombuffer(ids, "<u4").tolist() == want, t
                assert enc.decode(ids) == library.decode(want, skip_special_tokens=False) == t


def test_a_full_cache_is_emptied_not_overrun(vocab, library, monkeypatch):
    monkeypatch.setattr(B, "CACHE_ENTRIES", 50)
    enc = B.Encoder(vocab)
    for k in range(10):
        t = prose(k, 200)
        assert np.frombuffer(enc.encode([t, t])[1], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6), max_size=60), st.lists(st.binary(max_size=7), max_size=30))
def test_lexicon_is_a_minimal_map(words, others):
    own = sorted(words)
    ids = [hashlib.md5(w).digest()[: 4 * (1 + len(w) % 4)] for w in own]
    x = B.Lexicon.load(np.frombuffer(B.Lexicon.build(own, ids).dump(), np.uint8))
    assert x.outputs(x.find(own)) == ids if own else True
    assert [p < 0 for p in x.find(others)] == [w not in words for w in others] if others else True


def test_suffixes_are_shared():
    own = sorted(a + b for a in (b"walk", b"talk", b"stalk") for b in (b"", b"ed", b"er", b"ing", b"s"))
    x = B.Lexicon.build(own, [b"\1\0\0\0"] * len(own))
    assert len(x.edge_key) < sum(len(set(w[: k + 1] for w in own)) for k in range(8)) and len(x.final) - 1 < 20


def test_long_words_by_heap_equal_batches(vocab, library):
    rng = random.Random(4)
    for n in (49, 200, 5000):
        w = "".join(rng.choice("abcdeéz") for _ in range(n))
        assert np.frombuffer(vocab.merge([w.encode()])[0], "<u4").tolist() == library.encode(w, add_special_tokens=False).ids
    short = ["".join(rng.choice("abcdeéz") for _ in range(rng.randint(1, 20))).encode() for _ in range(300)]
    assert vocab.merge(short) == [vocab.merge_long(w).astype("<u4").tobytes() for w in short]


def test_round_trip_query(spark, library):
    want = []
    for i, t in edge_rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    for words in (0, 5, 10_000):
        got = B.round_trip(edge_docs(spark), words=words).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert B.round_trip(empty_docs(spark)).collect() == []


def test_frequent_words_fit_the_bound(spark):
    counts = spark.createDataFrame([(f"w{k}", 1000 // (k + 1)) for k in range(200)] + [(f"x{k}", 1) for k in range(500)], "word string, n long")
    for size in (0, 1, 10, 150, 10_000):
        got = B.frequent(counts, size)
        assert len(got) <= size and len(set(got)) == len(got)
        n = {r["word"]: r["n"] for r in counts.collect()}
        rest = [v for w, v in n.items() if w not in set(got)]
        assert not got or not rest or min(n[w] for w in got) >= max(rest)


# ---- packing


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[-1][0] + own[-1][1] <= capacity
    return len(bins)


def test_pieces_and_places(spark, library):
    got = K.pack_documents(edge_docs(spark)).collect()
    check_packing(got, 2048)
    docs = {}
    for r in got:
        docs.setdefault(r["doc_id"], []).append(r)
    for i, t in edge_rows():
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048 if len(ids) > 2048 else len(ids)
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        want = [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        mine = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in docs[i])
        assert set(want) <= set(mine)
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in edge_rows())
    assert sum(r["length"] for r in got) == total
    assert K.pack_documents(empty_docs(spark)).collect() == []


def simulate(counts, capacity):
    """Sequences that the plan makes, filled piece by piece."""
    fill = {}
    done = np.zeros(capacity + 1, int)
    for size, rank, number, first, per, offset in K.plan(counts, capacity).tolist():
        assert done[size] == rank
        done[size] += number
        for k in range(number):
            fill.setdefault(first + k // per, []).append((offset + k % per * size, size))
    assert (done == counts).all()
    for own in fill.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= capacity
    return len(fill)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 9)), max_size=40))
def test_plan_is_valid_and_tight(pieces):
    counts = np.zeros(61, int)
    for size, n in pieces:
        counts[size] += n
    used = simulate(counts, 60)
    total = int((counts * np.arange(61)).sum())
    large = int(counts[31:].sum())
    assert used <= max(large, -(-total * 3 // 120)) + counts[21:31].sum() // 2 + 2 + total // 60


def test_plan_beats_first_fit_on_shuffled_lengths():
    rng = np.random.default_rng(0)
    sizes = np.minimum(2048, rng.lognormal(6.3, 1, 5000).astype(int) + 1)
    counts = np.bincount(sizes, minlength=2049)
    bins = []
    for s in sorted(sizes, reverse=True):
        for k, room in enumerate(bins):
            if room >= s:
                bins[k] -= s
                break
        else:
            bins.append(2048 - s)
    assert simulate(counts, 2048) <= len(bins) * 1.01


# ---- token files


def test_counts_from_files(spark, library):
    library.encode_special_tokens = True
    try:
        want = sorted(((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in edge_rows()), key=repr)
    finally:
        library.encode_special_tokens = False
    assert sorted(map(tuple, S.document_tokens(edge_docs(spark)).collect()), key=repr) == want
    assert S.document_tokens(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("block", [1, 3, 7, 64, 1 << 19])
@pytest.mark.parametrize("digits", [0, 5])
def test_blocks_are_stitched(spark, tmp_path, block, digits):
    rng = np.random.default_rng(9)
    want = []
    for f in range(3):
        out = b""
        for k in range(12):
            n = int(rng.choice([0, 1, 2, 5, 20]))
            doc = int(rng.integers(-(1 << 62), 1 << 62))
            out += (S.header(doc) if digits else b"") + rng.integers(0, S.END, n).astype("<u2").tobytes() + np.array([S.END], "<u2").tobytes()
            want.append((doc if digits else None, k, n))
        (tmp_path / f"part-{f}.bin").write_bytes(out + (b"\1\0\2\0\3" if f == 1 else b""))  # a rest that no document ends
    (tmp_path / "part-3.bin").write_bytes(b"")
    got = S.count_tokens(spark, str(tmp_path), digits, block)
    assert sorted(((r["doc_id"], r["number"], r["n_tokens"]) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_headers_hold_every_long():
    for x in (0, 1, -1, 50256, (1 << 63) - 1, -(1 << 63) + 1, 12345678901234):
        d = np.frombuffer(S.header(x), "<u2")
        assert S.END not in d and S.read_headers(d[None].astype(np.int64))[0] == x


@pytest.mark.parametrize("run", [" ", "\n", " \n"])
def test_a_million_blanks(spark, library, run):
    """More than the library behind packing and token files can split."""
    text = "a b" + run * (1_500_000 // len(run)) + "<|endoftext|> c"
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
    got = sorted(K.pack_documents(docs).where("doc_id = 1").collect(), key=lambda r: r["piece"])
    assert [r["ids_crc32"] for r in got] == [zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in got] and sum(r["length"] for r in got) == len(ids)
    library.encode_special_tokens = True
    try:
        n = len(library.encode(text, add_special_tokens=False).ids)
    finally:
        library.encode_special_tokens = False
    assert sorted(map(tuple, S.document_tokens(docs).collect())) == [(1, n), (2, 1)]


def test_vocabulary_from_ranks_is_the_same(vocab):
    import base64
    with open(K.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = B.Vocabulary.of_ranks(ranks, {"<|endoftext|>": len(ranks)})
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeéz日 '") for _ in range(rng.randint(1, 60))).encode() for _ in range(800)]
    assert other.merge(words) == vocab.merge(words) and other.token_bytes == vocab.token_bytes

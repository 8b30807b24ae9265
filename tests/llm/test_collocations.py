"""Phrase collocations: the index against plain search, the result against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rowmill.llm import collocations as C
from tests.llm.cases import EXTRA, empty_docs, tuples


def brute(rows, min_count=100, longest=5, first=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for k in range(len(words) - size + 1):
                    f[lang, tuple(words[k : k + size])] += 1
    often = {k: n for k, n in f.items() if n >= min_count and len(k[1]) > 1}
    covered = set()
    for (lang, words), n in often.items():
        for size in range(2, len(words)):
            for k in range(len(words) - size + 1):
                if 100 * n >= 100 * often[lang, words[k : k + size]]:
                    covered.add((lang, words[k : k + size]))
    found = defaultdict(list)
    for (lang, words), a in often.items():
        if (lang, words) not in covered:
            score, k = min((1000 * a * total[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words)))
            found[lang].append((-score, -a, " ".join(words).encode(), k, words))
    out = []
    for lang, own in found.items():
        for rank, (score, a, phrase, k, words) in enumerate(sorted(own)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, f[lang, words[:k]], f[lang, words[k:]], total[lang], -score))
    return sorted(out, key=repr)


def wordy_rows(n=400, seed=3):
    rng = random.Random(seed)
    words = "Der die das und Haus Baum été x1 a's der-die -- é 日本 zz qq".split()
    fixed = ["new york city hall", "a a a a a a", "one two three four five six seven", "und und", "once"]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rng.randrange(1, 30)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(words, k=rng.randrange(1, 8))))
            parts.append(rng.choice([" ", ". ", ",", "\n", "\t\t", ";;", " \r\n ", "\x0b"]))
        rows.append((rng.choice(["de", "en", None, "und", ""]), "".join(parts)))
    return rows + [("en", None), (None, None), ("fr", ""), ("fr", "  \t "), ("fr", "lone"), ("de", rows[0][1])] + [rows[1]] * 3


@pytest.mark.parametrize("block", [1, 50, C.BLOCK])
def test_index_finds_what_search_finds(monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rng = np.random.default_rng(5)
    for wide, longest in ((3, 5), (40, 4), (3000, 5)):
        text = np.append(rng.integers(0, wide, 4000), 0)
        counts = Counter()
        for size in range(2, longest + 1):
            for k in range(len(text) - size + 1):
                if (text[k : k + size] > 0).all():
                    counts[tuple(text[k : k + size].tolist())] += 1
        for size in (2, 3):
            base = np.array(sorted(k for k in counts if len(k) == size))
            base = base[rng.random(len(base)) < 0.8]
            ok = set(map(tuple, base.tolist()))
            got = {tuple(w): int(n) for words, number in C.phrases(text, base, wide, longest) for w, n in zip(words.tolist(), number)}
            want = {k: n for k, n in counts.items() if len(k) > size and all(k[i : i + size] in ok for i in range(len(k) - size + 1))}
            assert got == want
            short, again, used = C.narrowed(text, base)
            assert len(short) <= len(text) and set(map(tuple, used[again].tolist())) == ok
            got = {tuple(used[w].tolist()): int(n) for words, number in C.phrases(short, again, len(used), longest) for w, n in zip(words, number)}
            assert got == want


@pytest.mark.parametrize("shard_words", [C.SHARD_WORDS, 700, 1])
def test_equals_brute_force(spark, monkeypatch, shard_words):
    monkeypatch.setattr(C, "STEP", 1 << 20 if shard_words > 1000 else 64)
    monkeypatch.setattr(C, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(C, "PART", C.PART if shard_words > 1000 else 50)  # lists of several parts
    rows = wordy_rows() if shard_words > 1 else wordy_rows(60)
    docs = spark.createDataFrame([(k, t, lang, *["mine"] * len(EXTRA)) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in EXTRA)).repartition(3)
    for min_count, longest, first in ((100 if shard_words > 1 else 10, 5, 2000), (2, 3, 7)):
        want = brute(rows, min_count, longest, first)
        assert tuples(C.collocations(docs, min_count, longest, first)) == want and want


def test_splits_of_texts_lose_nothing(monkeypatch):
    rows = wordy_rows(50)
    whole = [[w for t in [text.encode()] for part in C.tokens(t) for w in part] for _, text in rows if text]
    monkeypatch.setattr(C, "STEP", 9)
    assert whole == [[w for part in C.tokens(text.encode()) for w in part] for _, text in rows if text]
    monkeypatch.setattr(C, "SHARD_WORDS", 20)
    builder, found = C.Builder(), []
    for _, text in rows:
        found += builder.add((text or "").encode())
    found.append(builder.shard())
    assert len(found) > 20 and all(f["ids"][-1] == 0 for f in found)
    spelled = [b"" if k == 0 else f["words"][k - 1] for f in found for k in f["ids"]]
    assert [w for w in spelled if w] == [w for words in whole for w in words if w != b"\n"]
    assert sum(f["n_words"] for f in found) == sum(w != b"\n" for words in whole for w in words)


def test_edges(spark):
    assert C.collocations(empty_docs(spark)).collect() == []
    long = "word " * 400_000 + "\n" * 1_200_000 + " " * 1_200_000
    got = C.collocations(spark.createDataFrame([(1, "en", long), (2, "en", "!" * 100)], "doc_id long, lang string, text string")).collect()
    # "word" five times holds all shorter ones, but occurs less often: they stay
    assert [(r["phrase"].count("word"), r["a"]) for r in sorted(got, key=lambda r: -r["a"])] == [(k, 400_001 - k) for k in (2, 3, 4, 5)]

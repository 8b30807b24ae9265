"""Byte-level BPE with a minimal acyclic transducer as lexicon.

The corpus' most frequent words are compiled into a minimal acyclic automaton
(common suffixes share states) whose edges carry additive outputs: their sum along
a word's path is the word's place in the table of ids.  The automaton is one file
in the shared folder, handed to the executors with ``addFile`` and memory-mapped
there.  Words that it lacks are merged exactly, many at a time: every step merges
the pair of lowest rank of each word of a batch.

Any lexicon gives the same ids; its size only sets how many words need merging.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm.common import id_text, put_shared, strings, written

#: Fixed value: the splitting pattern of byte-level BPE vocabularies of this family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Frequent words compiled into the lexicon.
LEXICON_WORDS = 200_000
#: Longer words are merged one by one with a heap, shorter ones in batches.
BATCH_BYTES = 48
#: Bounds a worker's memory: entries of its cache of space-separated chunks (about 200 bytes each).
CACHE_ENTRIES = 1_000_000
#: Different chunks that a task counts before it passes their words on.
COUNT_ENTRIES = 400_000
NONE = np.iinfo(np.int32).max


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in vocabulary files: printable Latin-1 bytes stand for
    themselves, the others follow from U+0100 on in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """A vocabulary file as arrays (its size bounds what is broadcast)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        back = byte_alphabet()
        ids = file["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in file["added_tokens"] if x["special"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.size = size
        self.token_bytes: list[bytes] = [b""] * size
        for token, k in ids.items():
            if token not in self.special:
                self.token_bytes[k] = bytes(back[c] for c in token)
        for token, k in self.special.items():
            self.token_bytes[k] = token.encode()
        self.byte_id = np.zeros(256, np.int32)
        for c, b in back.items():
            self.byte_id[b] = ids[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        out = np.array([ids[a + b] for a, b in merges], np.int32)
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.pair_key, self.pair_rank, self.pair_out = keys[order], order.astype(np.int32), out[order]

    @classmethod
    def of_ranks(cls, ranks: dict[bytes, int], special: dict[str, int]) -> "Vocabulary":
        """From tokens and their ranks, which are their ids: two neighbours merge to the token that they spell."""
        self = cls.__new__(cls)
        self.special = dict(special)
        self.size = max([*ranks.values(), *special.values()]) + 1
        self.token_bytes = [b""] * self.size
        for token, k in [*ranks.items(), *((t.encode(), k) for t, k in special.items())]:
            self.token_bytes[k] = token
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {ranks[t[:k]] * self.size + ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        keys = np.array(list(pairs), np.int64)
        order = np.argsort(keys)
        out = np.array(list(pairs.values()), np.int32)[order]
        self.pair_key, self.pair_rank, self.pair_out = keys[order], out, out
        return self

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE without a merge) and result of each pair; b < 0: no right neighbour."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        hit = (self.pair_key[at] == key) & (b >= 0) & (a >= 0)
        return np.where(hit, self.pair_rank[at], NONE), self.pair_out[at]

    def merge_long(self, word: bytes) -> np.ndarray:
        """One long word: a heap of pairs over a linked list, n log n."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, out = self.find(np.array(ids[:-1]), np.array(ids[1:])) if n > 1 else (np.zeros(0), np.zeros(0))
        heap = [(int(r), i, ids[i], ids[i + 1], int(o)) for i, (r, o) in enumerate(zip(rank, out)) if r != NONE]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = merged, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n:
                    r, o = self.find(np.array([ids[x]]), np.array([ids[y]]))
                    if r[0] != NONE:
                        heapq.heappush(heap, (int(r[0]), x, ids[x], ids[y], int(o[0])))
        return np.array([x for x in ids if x >= 0], np.uint32)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        result: list[bytes] = [b""] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        for k in order[lengths[order] > BATCH_BYTES]:
            result[k] = self.merge_long(words[k]).astype("<u4").tobytes()
        order = order[lengths[order] <= BATCH_BYTES]
        step = 20_000
        for at in range(0, len(order), step):
            rows = order[at : at + step]
            self._merge_block([words[k] for k in rows], rows, result)
        return result

    def _merge_block(self, words: list[bytes], rows: np.ndarray, result: list[bytes]) -> None:
        n, wide = np.array([len(w) for w in words]), max(map(len, words))
        ids = np.full((len(words), wide + 1), -1, np.int32)
        ids[np.arange(wide + 1) < n[:, None]] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        rank, out = self.find(ids[:, :-1], ids[:, 1:])
        columns = np.arange(wide + 1)
        while len(rows):
            best = rank.argmin(1)
            at = np.arange(len(rows))
            done = rank[at, best] == NONE
            if done.any():
                for k, row, m in zip(rows[done], ids[done], n[done]):
                    result[k] = row[:m].astype("<u4").tobytes()
                keep = ~done
                rows, ids, n, rank, out, best = rows[keep], ids[keep], n[keep], rank[keep], out[keep], best[keep]
                if not len(rows):
                    break
                wide = int(n.max())
                ids, rank, out, columns = ids[:, : wide + 1], rank[:, :wide], out[:, :wide], columns[: wide + 1]
                at = np.arange(len(rows))
            merged = out[at, best]
            move = np.minimum(columns + (columns > best[:, None]), wide)
            ids = np.take_along_axis(ids, move, 1)
            n = n - 1
            ids[at, best], ids[:, wide] = merged, -1
            ids[at, n] = -1
            move = np.minimum(columns[:-1] + (columns[:-1] > best[:, None]), wide - 1)
            rank, out = np.take_along_axis(rank, move, 1), np.take_along_axis(out, move, 1)
            rank[at, n - 1] = NONE
            rank[at, best], out[at, best] = self.find(ids[at, best], ids[at, best + 1])
            some = best > 0
            i, j = at[some], best[some]
            rank[i, j - 1], out[i, j - 1] = self.find(ids[i, j - 1], ids[i, j])


class Lexicon:
    """Minimal acyclic transducer over bytes: word -> ids, as flat arrays over one buffer."""

    FIELDS = (("edge_key", "<i8"), ("edge_to", "<i4"), ("edge_out", "<i4"), ("final", "<i4"), ("start", "<i4"), ("ids", "<u4"))

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, words: list[bytes], ids: list[bytes]) -> "Lexicon":
        """Words in ascending order, without repeats; states are shared as soon as they are complete."""
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def complete(final: bool, edges: list[tuple[int, int]]) -> int:
            key = (final, tuple(edges))
            k = register.get(key)
            if k is None:
                k = register[key] = len(states)
                states.append(key)
            return k

        path: list[list] = [[False, []]]  # of the last word: [final, edges]; the last edge's target is open
        last = b""
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            while len(path) - 1 > same:
                final, edges = path.pop()
                path[-1][1][-1] = (path[-1][1][-1][0], complete(final, edges))
            for b in word[same:]:
                path[-1][1].append((b, -1))
                path.append([False, []])
            path[-1][0] = True
            last = word
        while len(path) > 1:
            final, edges = path.pop()
            path[-1][1][-1] = (path[-1][1][-1][0], complete(final, edges))
        root = complete(*path[0])
        count = np.zeros(len(states), np.int64)  # targets come before their sources
        key, to, out = [], [], []
        for s, (final, edges) in enumerate(states):
            count[s] = final
            for b, t in edges:
                key.append(s * 256 + b)
                to.append(t)
                out.append(int(count[s]))
                count[s] += count[t]
        return cls(
            edge_key=np.array(key, "<i8"), edge_to=np.array(to, "<i4"), edge_out=np.array(out, "<i4"),
            final=np.array([f for f, _ in states] + [root], "<i4"),
            start=np.cumsum([0, *(len(x) // 4 for x in ids)]).astype("<i4"), ids=np.frombuffer(b"".join(ids), "<u4"),
        )

    def dump(self) -> bytes:
        arrays = [np.asarray(getattr(self, n)).astype(t) for n, t in self.FIELDS]
        return np.array([len(a) for a in arrays], "<i8").tobytes() + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def load(cls, buffer) -> "Lexicon":
        sizes = np.frombuffer(buffer[: 8 * len(cls.FIELDS)], "<i8")
        at, arrays = 8 * len(cls.FIELDS), {}
        for (name, kind), n in zip(cls.FIELDS, sizes):
            arrays[name] = np.frombuffer(buffer, kind, int(n), at)
            at += int(n) * np.dtype(kind).itemsize
        return cls(**arrays)

    @classmethod
    def mapped(cls, path: str) -> "Lexicon":
        return cls.load(np.memmap(path, np.uint8, "r"))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the table of ids, -1 if it isn't in the lexicon; all words step together."""
        n = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(n) - n
        flat = np.frombuffer(b"".join(words), np.uint8)
        state = np.full(len(words), int(self.final[-1]), np.int64)
        place = np.zeros(len(words), np.int64)
        rows = np.flatnonzero(n > 0) if len(self.edge_key) else np.zeros(0, np.int64)
        state[n == 0] = -1
        if not len(self.edge_key):
            state[:] = -1
        depth = 0
        while len(rows):
            key = state[rows] * 256 + flat[first[rows] + depth]
            at = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
            hit = self.edge_key[at] == key
            state[rows] = np.where(hit, self.edge_to[at], -1)
            place[rows] += np.where(hit, self.edge_out[at], 0)
            depth += 1
            rows = rows[hit & (n[rows] > depth)]
        ok = (state >= 0) & (self.final[np.maximum(state, 0)] > 0)
        return np.where(ok, place, -1)

    def outputs(self, places: np.ndarray) -> list[bytes]:
        raw = memoryview(np.ascontiguousarray(self.ids)).cast("B") if len(self.ids) else b""
        return [bytes(raw[a:b]) for a, b in zip((4 * self.start[places].astype(int)).tolist(), (4 * self.start[places + 1].astype(int)).tolist())]


class Encoder:
    """Encodes texts in one worker.  ``lexicon`` may be None: every word is then merged."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon | None = None):
        self.vocab, self.lexicon = vocab, lexicon
        self.split = regex.compile(PATTERN).findall
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(vocab.special, key=len, reverse=True))) + ")") if vocab.special else None
        self.cache: dict[str, bytes | None] = {}

    def words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words: from the lexicon, else by merging."""
        raw = [w.encode() for w in words]
        result: list[bytes] = [b""] * len(raw)
        if self.lexicon is not None and raw:
            place = self.lexicon.find(raw)
            known = np.flatnonzero(place >= 0)
            for k, ids in zip(known.tolist(), self.lexicon.outputs(place[known])):
                result[k] = ids
            rest = np.flatnonzero(place < 0)
        else:
            rest = np.arange(len(raw))
        for k, ids in zip(rest, self.vocab.merge([raw[k] for k in rest])):
            result[k] = ids
        return dict(zip(words, result))

    def learn(self, chunks: set[str]) -> None:
        """Put chunks into the cache, each as it is encoded after a single space.  A chunk that is
        empty or has white space at an end doesn't stand on its own: None."""
        if len(self.cache) + len(chunks) > CACHE_ENTRIES:
            self.cache.clear()
        split = {c: self.split(" " + c) for c in chunks if c and not c[0].isspace() and not c[-1].isspace()}
        ids = self.words(list({w for x in split.values() for w in x}))
        self.cache.update((c, b"".join([ids[w] for w in split[c]]) if c in split else None) for c in chunks)

    def plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens.  A space between two other characters always starts
        a word, so what lies between such spaces is encoded once and kept."""
        chunks = [t.split(" ") for t in texts]
        new: set[str] = set()
        for c in chunks:
            new.update(c[1:])
        get = self.cache.get
        new = {c for c in new if c not in self.cache}
        if new:
            if len(self.cache) + len(new) > CACHE_ENTRIES:
                new = {c for x in chunks for c in x[1:]}
            self.learn(new)
        head = {}
        odd = {}
        for k, (t, c) in enumerate(zip(texts, chunks)):
            if len(c) == 1 or not c[0] or c[0][-1].isspace() or None in (found := list(map(get, c[1:]))):
                odd[k] = self.split(t)
            else:
                head[k] = (self.split(c[0]), found)
        ids = self.words(list({w for x in odd.values() for w in x} | {w for x, _ in head.values() for w in x}))
        return [b"".join([ids[w] for w in odd[k]]) if k in odd else b"".join([ids[w] for w in head[k][0]] + head[k][1]) for k in range(len(texts))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; the strings of special tokens
        become their ids."""
        pieces: list[str] = []
        layout: list[list[int | bytes]] = []
        for t in texts:
            row: list[int | bytes] = []
            for x in self.marks.split(t) if self.marks and "<|" in t else (t,):
                if x in self.vocab.special:
                    row.append(np.uint32(self.vocab.special[x]).astype("<u4").tobytes())
                elif x:
                    row.append(len(pieces))
                    pieces.append(x)
            layout.append(row)
        out = self.plain(pieces)
        return [b"".join([out[x] if isinstance(x, int) else x for x in row]) if len(row) != 1 or not isinstance(row[0], int) else out[row[0]] for row in layout]

    def decode(self, ids: bytes) -> str:
        of = self.vocab.token_bytes
        return b"".join([of[k] for k in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def few(batches: Iterator[pa.RecordBatch], rows: int = 500, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of bounded bytes, so that very long texts don't pile up in one step."""
    for batch in batches:
        step = max(1, min(rows, int(batch.num_rows * size / max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; counts are summed in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(PATTERN).findall
        inner: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            words: Counter[str] = Counter()
            for c, n in inner.items():
                for w in split(c):
                    words[w] += n
            inner.clear()
            return pa.RecordBatch.from_pydict({"word": pa.array(words.keys(), pa.string()), "n": pa.array(words.values(), pa.int64())})

        for batch in few(batches):
            for t in strings(batch.column("text")):
                first, *rest = t.split(" ")
                inner[first] += 1
                inner.update([" " + c for c in rest])
            if len(inner) > COUNT_ENTRIES:
                yield out()
        yield out()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, size: int) -> list[str]:
    """The most frequent words, as many as fit ``size`` when taken by sixteenths of powers of two of
    their counts.  The driver gets a histogram of at most 1024 numbers, then at most ``size`` words."""
    counts = written(counts.withColumn("level", F.floor(F.log2("n") * 16)), "words")
    total, cut = 0, None
    for row in counts.groupBy("level").agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        total += row["words"]
        if total > size:
            break
        cut = row["level"]
    return [] if cut is None else [r["word"] for r in counts.where(F.col("level") >= cut).select("word").collect()]


def lexicon_file(docs: DataFrame, vocab: Vocabulary, size: int = LEXICON_WORDS) -> str:
    """Compile at most ``size`` of the most frequent words and ship the file."""
    words = sorted(w.encode() for w in frequent(count_words(docs), size) if w)
    return put_shared(docs.sparkSession, Lexicon.build(words, vocab.merge(words)).dump(), "lexicon")


_OPEN: dict[tuple, Encoder] = {}


def encoder(vocab: Vocabulary, key: str, file: str | None = None) -> Encoder:
    """The worker's encoder; kept while the worker lives, so that its cache stays warm."""
    if (key, file) not in _OPEN:
        _OPEN.clear()
        _OPEN[key, file] = Encoder(vocab, Lexicon.mapped(SparkFiles.get(file)) if file else None)
    return _OPEN[key, file]


def round_trip(docs: DataFrame, path: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """Encode every whole text and decode it again.

    Input: ``doc_id``, ``text``.  Output, one row per input row in any order: ``doc_id``,
    ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers),
    ``decoded_sha256`` (UTF-8).  Null and empty texts give 0 tokens and the digests of nothing;
    a null ``doc_id`` stays null; repeated rows are each encoded; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = id_text(docs)
    vocab = Vocabulary(path or default_path())
    file = lexicon_file(docs, vocab, words)
    shared = spark.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, "round_trip", file)
        for batch in few(batches):
            ids = enc.encode(strings(batch.column("text")))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(enc.decode(x).encode()).hexdigest() for x in ids],
                }
            )

    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids binary) for every row; the operator's plain output for other uses."""
    vocab = docs.sparkSession.sparkContext.broadcast(Vocabulary(path or default_path()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab.value, "encode_ids")
        for batch in few(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": pa.array(enc.encode(strings(batch.column("text"))), pa.binary())})

    return id_text(docs).mapInArrow(run, "doc_id long, ids binary")

"""Phrase collocations from an FM-index per shard.

1. Every task turns its texts into shards of one language: word ids with a separator between pieces, and
   the shard's own words.  Counts of words are summed over shards; words too rare for any phrase go.
2. Each shard indexes what is left of it and extends the interval of every word by one word to the left: a
   list of left neighbours with counts for each word.  The lists of a word are summed over shards.
3. Each shard keeps only words that lie in a frequent pair, builds its index (the Burrows-Wheeler
   transform of the ids, sorted as deep as the longest phrase sought) and extends the pairs' intervals
   through pairs that are frequent; what comes before a word is summed over shards.
4. The same once more for what is longer, within frequent triples: a forward and a backward index, whose
   intervals are extended together, to the left and to the right by turns.
5. All frequent phrases are one table; parts of a phrase, and phrases one word longer, are looked up in it by joins.

A phrase can't be more frequent than its parts, so no step drops one that reaches the count.  A shard holds
a bounded number of words.  A frequent word's lists are dealt out by a hash of the neighbour into so many parts
that the parts of all words are of one size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.bpe import few
from rowmill.llm.common import binary, ship_code, written

#: Words that a shard holds; it ends with the piece that reaches them.
SHARD_WORDS = 2_000_000
#: Bits for the shards of a task, and for the words of a shard: 20 are left for the tasks.
SHARD_BITS, WORD_BITS = 16, 27
#: Bytes of one text that are split at a time.
STEP = 4 << 20
#: Places of an index that are looked at together.
BLOCK = 1 << 19
#: Occurrences of a word for which its lists get another part.
PART = 100_000
MIN_COUNT = 100
LONGEST = 5
FIRST = 2000
#: What ends a piece, and what ends a word.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

SHARDS = "shard long, lang string, n_words long, ids binary, words binary, counts binary"


def packed(data: bytes) -> bytes:
    """Its length in eight bytes, then ``data`` compressed."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, A-Z lower-cased, with a line feed for each end of a piece; in steps."""
    table = bytes.maketrans(PIECE_ENDS + WORD_ENDS, b"\n" * len(PIECE_ENDS) + b" " * len(WORD_ENDS))
    at = 0
    while at < len(text):
        end = at + STEP
        if end < len(text):  # go on to where no word is cut
            end = min((x for c in b" \t\n.," if (x := text.find(c, end)) >= 0), default=len(text))
        part = text[at:end].lower().translate(table)
        yield [w for w in part.replace(b"\n", b" \n ").split(b" ") if w]
        at = end


class Builder:
    """Collects the texts of one language in a task."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        numbers = count(1)
        self.place: dict[bytes, int] = _Numbered(numbers)
        self.place[b"\n"] = 0
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> Iterator[dict]:
        for words in tokens(text):
            new = np.fromiter(map(self.place.__getitem__, words), np.uint32, len(words))
            while self.size + len(new) >= SHARD_WORDS and len(ends := np.flatnonzero(new == 0)):
                cut = int(ends[min(len(ends) - 1, np.searchsorted(ends, max(0, SHARD_WORDS - self.size)))]) + 1
                tail = [w for w in words[cut:]]
                self.ids.append(new[:cut])
                yield self.shard()
                self.clear()
                words = tail
                new = np.fromiter(map(self.place.__getitem__, words), np.uint32, len(words))
            self.ids.append(new)
            self.size += len(new)
        self.ids.append(np.zeros(1, np.uint32))
        self.size += 1

    def shard(self) -> dict:
        ids = np.concatenate([*self.ids, np.zeros(1, np.uint32)])
        words = list(self.place)[1:]
        counts = np.bincount(ids, minlength=len(words) + 1)[1:]
        used = np.flatnonzero(counts)
        again = np.zeros(len(words) + 1, np.int64)
        again[used + 1] = np.arange(1, len(used) + 1)
        return {"n_words": int(counts.sum()), "ids": again[ids], "words": [words[k] for k in used], "counts": counts[used]}


class _Numbered(dict):
    def __init__(self, numbers: Iterator[int]):
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: bytes) -> int:
        self[word] = k = next(self.numbers)
        return k


def shards(docs: DataFrame) -> DataFrame:
    """Rows of ``SHARDS``; no text is shuffled.  ``words`` has the shard's words by id from 1, joined by line feeds."""
    ship_code(docs.sparkSession)
    names = [x.split()[0] for x in SHARDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, Builder] = {}
        numbers = count(TaskContext.get().partitionId() << SHARD_BITS)

        def row(lang: str, s: dict) -> pa.RecordBatch:
            data = (packed(s["ids"].astype("<u4").tobytes()), packed(b"\n".join(s["words"])), packed(s["counts"].astype("<u4").tobytes()))
            columns = [pa.array([next(numbers)], pa.int64()), pa.array([lang]), pa.array([s["n_words"]], pa.int64()), *(pa.array([d], pa.binary()) for d in data)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in few(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), binary(batch.column("text"))):
                if lang not in own:
                    own[lang] = Builder()
                for s in own[lang].add(text):
                    yield row(lang, s)
        for lang, builder in own.items():
            yield row(lang, builder.shard())

    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return own.where("text <> ''").mapInArrow(run, SHARDS)


def load_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(unpacked(data), "<u4").astype(np.int64)


def load_words(data: bytes) -> pa.Array:
    """The separator's empty text, then the shard's words."""
    raw = unpacked(data)
    return pa.array([b"", *(raw.split(b"\n") if raw else [])], pa.binary()).cast(pa.string())


class FMIndex:
    """Burrows-Wheeler transform of ids with separators (0), its suffixes sorted by their first ``depth`` ids.
    That is deep enough to extend intervals of fewer than ``depth`` ids."""

    def __init__(self, text: np.ndarray, depth: int):
        n, symbols = len(text), int(text.max(initial=0)) + 1
        bits = max(1, int(symbols).bit_length())
        padded = np.append(text, np.zeros(depth, np.int64))
        keys, per = [], max(1, 63 // bits)
        for at in range(0, depth, per):
            key = np.zeros(n, np.int64)
            for k in range(at, min(depth, at + per)):
                key = (key << bits) | padded[k : k + n]
            keys.append(key)
        order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
        self.bwt = text[order - 1]
        self.starts = np.append(0, np.cumsum(np.bincount(text, minlength=symbols)))
        self.wide = n + 1
        self.ranks = np.sort(self.bwt * self.wide + np.arange(n))

    def first(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.starts[symbols], self.starts[symbols + 1]

    def before(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the suffixes start that have a symbol before those from place ``at`` on."""
        return np.searchsorted(self.ranks, symbols * self.wide + at)

    def extensions(self, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(interval, symbol, number, number of smaller symbols) for each symbol that comes before an interval, some
        intervals at a time; separators count as smaller symbols but aren't returned."""
        total = np.cumsum(hi - lo)
        symbols = len(self.starts)
        at = 0
        while at < len(lo):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, "right")))
            size = hi[at:to] - lo[at:to]
            ends = np.cumsum(size)
            owner = np.repeat(np.arange(to - at), size)
            place = np.arange(len(owner)) + np.repeat(lo[at:to] - ends + size, size)
            pairs, number = np.unique(owner * symbols + self.bwt[place], return_counts=True)
            owner, symbol = pairs // symbols, pairs % symbols
            running = np.cumsum(number) - number
            smaller = running - (ends - size)[owner]
            real = symbol > 0
            yield at + owner[real], symbol[real], number[real], smaller[real]
            at = to


def members(found: np.ndarray, sought: np.ndarray, symbols: int) -> np.ndarray:
    """Which rows of ``sought`` are rows of ``found``; numbers below ``symbols``."""
    a, b = np.zeros(len(found), np.int64), np.zeros(len(sought), np.int64)
    for k in range(found.shape[1]):  # a number for each different beginning
        both = np.concatenate([a, b]) * symbols + np.concatenate([found[:, k], sought[:, k]])
        both = np.unique(both, return_inverse=True)[1]
        a, b = both[: len(a)], both[len(a) :]
    return np.isin(b, a)


def phrases(text: np.ndarray, base: np.ndarray, symbols: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word ids, counts) of the phrases one word longer than the rows of ``base``, then two, and so on, all of whose
    parts of that length are rows of it."""
    wide = base.shape[1]
    forward = FMIndex(text, longest)
    backward = FMIndex(text[::-1], longest) if longest > wide + 1 else None
    words = base

    def sought(index: FMIndex, order: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the base by backward search."""
        lo, hi = index.first(words[:, order[0]])
        for k in order[1:]:
            lo, hi = index.before(words[:, k], lo), index.before(words[:, k], hi)
        return lo, hi

    lo, hi = sought(forward, list(range(wide))[::-1])
    back = sought(backward, list(range(wide)))[0] if backward else lo
    for depth in range(wide + 1, longest + 1):
        left = (depth - wide) % 2 == 1
        steps = []
        for owner, symbol, number, smaller in forward.extensions(lo, hi) if left else backward.extensions(back, back + hi - lo):
            new = [symbol[:, None], words[owner]] if left else [words[owner], symbol[:, None]]
            new = np.concatenate(new, 1)
            keep = members(base, new[:, :wide] if left else new[:, -wide:], symbols)
            steps.append((new[keep], owner[keep], symbol[keep], number[keep], smaller[keep]))
        if not steps:
            return
        words, owner, symbol, number, smaller = (np.concatenate(x) for x in zip(*steps))
        if depth < longest:
            if left:
                lo, back = forward.before(symbol, lo[owner]), back[owner] + smaller
            else:
                lo, back = lo[owner] + smaller, backward.before(symbol, back[owner])
            hi = lo + number
        yield words, number


def left_neighbours(text: np.ndarray, base: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of ``base``, word before it, count) where that word and the row's beginning are a row of ``base`` too."""
    wide = base.shape[1]
    index = FMIndex(text, wide)
    lo, hi = index.first(base[:, -1])
    for k in range(wide - 2, -1, -1):
        lo, hi = index.before(base[:, k], lo), index.before(base[:, k], hi)
    for owner, symbol, number, _ in index.extensions(lo, hi):
        keep = members(base, np.concatenate([symbol[:, None], base[owner, :-1]], 1), symbols)
        yield owner[keep], symbol[keep], number[keep]


def narrowed(ids: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, base, used): only words that lie in one of the phrases ``base`` stay, numbered anew from 1; one
    separator between what is left.  ``used``: the old number of each."""
    wide, symbols = base.shape[1], int(ids.max(initial=0)) + 1
    n = len(ids) - wide + 1
    start = members(base, np.stack([ids[k : n + k] for k in range(wide)], 1), symbols) if n > 0 else np.zeros(0, bool)
    keep = np.zeros(len(ids), bool)
    for k in range(wide):
        keep[k : n + k] |= start
    text = np.where(keep, ids, 0)
    text = text[np.append(True, (text[1:] > 0) | (text[:-1] > 0))]
    used, again = np.unique(np.concatenate([[0], text, base.ravel()]), return_inverse=True)
    return again[1 : 1 + len(text)], again[1 + len(text) :].reshape(-1, wide), used


def frequent(rows: DataFrame, by: list[str], min_count: int) -> DataFrame:
    """Rows whose ``n``, summed over all with the same ``by``, reaches the count; ``total`` is the sum.  A key has one row per shard at most."""
    return rows.withColumn("total", F.sum("n").over(Window.partitionBy(*by))).where(F.col("total") >= min_count)


def word_counts(parts: DataFrame) -> DataFrame:
    """(shard, id, lang, word, n) of every shard's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lang, words, counts in zip(*(batch.column(c).to_pylist() for c in ("shard", "lang", "words", "counts"))):
                own, n = load_words(words).slice(1), load_ids(counts)
                if len(own):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), shard)), pa.array(np.arange(1, len(n) + 1)), pa.array([lang] * len(n)), own, pa.array(n)], ["shard", "id", "lang", "word", "n"])

    return parts.select("shard", "lang", "words", "counts").mapInArrow(run, "shard long, id long, lang string, word string, n long")


def lists_of(keys: list[str]) -> str:
    """Columns of rows of a shard: a word, by its number everywhere, and lists of what comes before it with counts."""
    return f"shard long, last long, part int, {', '.join(f'{k} array<long>' for k in keys)}, counts array<int>"


def listed(shard: int, last: np.ndarray, keys: dict[str, np.ndarray], number: np.ndarray, total: np.ndarray) -> pa.Table:
    """Rows of ``lists_of`` from entries; ``total``: how often all shards have each entry's word ``last``."""
    mixed = np.zeros(len(last), np.int64)
    for k in keys.values():
        mixed = (mixed ^ k) * 0x9E3779B1
    part = ((mixed >> 7) % (1 + total // PART)).astype(np.int32)
    order = np.lexsort((*keys.values(), part, last))
    last, part = last[order], part[order]
    new = np.ones(len(last), bool)
    new[1:] = (last[1:] != last[:-1]) | (part[1:] != part[:-1])
    start = np.flatnonzero(new)
    ends = pa.array(np.append(start, len(last)), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (*keys.values(), number.astype(np.int32))]
    return pa.Table.from_arrays([pa.array(np.full(len(start), shard), pa.int64()), pa.array(last[start]), pa.array(part[start]), *lists], names=["shard", "last", "part", *keys, "counts"])


def summed(rows: DataFrame, keys: list[str], min_count: int) -> DataFrame:
    """(shard, last, *keys, totals): of each row the entries whose counts, summed over all rows with the same word
    and part, reach ``min_count``; and rows without a shard that have them once."""
    by = ["last", "part"]
    names = ["shard", "last", *keys, "totals"]

    def changes(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for c in by:
            x = t.column(c).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return new

    def settled(t: pa.Table) -> Iterator[pa.RecordBatch]:
        group = np.cumsum(changes(t)) - 1
        lists = [t.column(k).combine_chunks() for k in keys]
        row = np.repeat(np.arange(t.num_rows), lists[0].value_lengths().to_numpy(zero_copy_only=False))
        entry = [x.flatten().to_numpy() for x in lists]
        count = t.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        order = np.lexsort((*entry, group[row]))
        new = np.zeros(len(order), bool)
        new[:1] = True
        for x in (group[row][order], *(e[order] for e in entry)):
            new[1:] |= x[1:] != x[:-1]
        start = np.flatnonzero(new)
        total = np.add.reduceat(count[order], start)
        every = np.empty(len(order), np.int64)
        every[order] = total[np.cumsum(new) - 1]
        enough = total >= min_count
        keep, once = np.flatnonzero(every >= min_count), order[start[enough]]
        shard, last = t.column("shard").combine_chunks(), t.column("last").combine_chunks()
        for own, chosen, sums in ((True, keep, every[keep]), (False, once, total[enough])):
            at = row[chosen] if own else group[row[chosen]]
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
            ends = pa.array(np.append(first, len(at)), pa.int32())
            rows = pa.array(row[chosen][first])
            columns = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (*(e[chosen] for e in entry), sums)]
            yield pa.RecordBatch.from_arrays([shard.take(rows) if own else pa.nulls(len(rows), pa.int64()), last.take(rows), *columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # rows of the last word and part so far
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            start = np.flatnonzero(changes(t))
            if held and before != tuple(t.column(c)[0].as_py() for c in by):
                yield from settled(pa.concat_tables(held))
                held = []
            if len(start) > 1:
                yield from settled(pa.concat_tables([*held, t.slice(0, start[-1])]))
                held = []
            held.append(t.slice(start[-1]))
            before = tuple(t.column(c)[-1].as_py() for c in by)
        if held:
            yield from settled(pa.concat_tables(held))

    ranged = rows.repartition(*by).sortWithinPartitions(*by)
    return ranged.mapInArrow(run, f"shard long, last long, {', '.join(f'{k} array<long>' for k in keys)}, totals array<long>")


PAIR, TRIPLE = ["lefts"], ["lefts", "mids"]


def with_words(grams: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of each shard: its frequent words (id there, last: number everywhere, total), and its frequent pairs or triples."""
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("id", "long"), ("total", "long"), ("lefts", "array<long>"), ("mids", "array<long>"), ("totals", "array<long>"))}
    words = known.select("shard", "id", F.col("word_id").alias("last"), "total", none["lefts"], none["mids"], none["totals"])
    own = grams.where("shard is not null").select("shard", none["id"], "last", none["total"], "lefts", "mids" if "mids" in grams.columns else none["mids"], "totals")
    return words.unionByName(own)


class Local:
    """What a shard is told: of its ids the ``names`` everywhere (0: none) and ``totals``, and the frequent phrases of ``wide`` words by ids."""

    def __init__(self, known: pa.Table, wide: int):
        word = known.column("id").is_valid().to_numpy()
        words, grams = known.filter(pa.array(word)), known.filter(pa.array(~word))
        own, name = words.column("id").to_numpy(), words.column("last").to_numpy()
        self.names, self.totals = np.zeros((2, int(own.max(initial=0)) + 1), np.int64)
        self.names[own], self.totals[own] = name, words.column("total").to_numpy()
        order = np.argsort(name)
        lists = [grams.column(k).combine_chunks() for k in TRIPLE[: wide - 1]]
        last = np.repeat(grams.column("last").to_numpy(), lists[0].value_lengths().to_numpy(zero_copy_only=False))
        columns = [*(x.flatten().to_numpy() for x in lists), last]
        self.grams = np.stack([own[order][np.searchsorted(name[order], x)] for x in columns], 1) if len(own) else np.zeros((0, wide), np.int64)


def pair_lists(parts: DataFrame, known: DataFrame) -> DataFrame:
    """``lists_of(PAIR)``: the left neighbours of frequent words that are frequent, in every shard."""

    def run(key: tuple, shard: pa.Table, known: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        out = [listed(0, none, {"lefts": none}, none, none)]
        if shard.num_rows and known.num_rows:
            ids = load_ids(shard.column("ids")[0].as_py())
            names, total = np.zeros((2, int(ids.max(initial=0)) + 1), np.int64)
            names[:] = -1
            names[known.column("id").to_numpy()] = known.column("word_id").to_numpy()
            total[known.column("id").to_numpy()] = known.column("total").to_numpy()
            ids = np.where(names[ids] >= 0, ids, 0)
            index = FMIndex(ids, 1)
            own = np.unique(ids[ids > 0])
            for owner, symbol, number, _ in index.extensions(*index.first(own)):
                out.append(listed(key[0].as_py(), names[own[owner]], {"lefts": names[symbol]}, number, total[own[owner]]))
        return pa.concat_tables(out)

    return parts.select("shard", "ids").groupBy("shard").cogroup(known.select("shard", "id", "word_id", "total").groupBy("shard")).applyInArrow(run, lists_of(PAIR))


def triple_lists(parts: DataFrame, known: DataFrame) -> DataFrame:
    """``lists_of(TRIPLE)``: what comes before the last word of triples through frequent pairs, in every shard."""

    def run(key: tuple, shard: pa.Table, known: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        local = Local(known, 2)
        steps = [(none, none, none, none)]
        if shard.num_rows and len(local.grams):
            text, base, used = narrowed(load_ids(shard.column("ids")[0].as_py()), local.grams)
            for owner, symbol, number in left_neighbours(text, base, len(used)):
                steps.append((used[symbol], used[base[owner, 0]], used[base[owner, 1]], number))
        first, second, last, number = (np.concatenate(x) for x in zip(*steps))
        return listed(key[0].as_py(), local.names[last], {"lefts": local.names[first], "mids": local.names[second]}, number, local.totals[last])

    return parts.select("shard", "ids").groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(run, lists_of(TRIPLE))


def phrase_counts(parts: DataFrame, known: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, n) of the phrases of 4 words and more through frequent triples."""

    def run(key: tuple, shard: pa.Table, known: pa.Table) -> pa.Table:
        lang, phrase, n = [], [pa.array([], pa.string())], [np.zeros(0, np.int64)]
        local = Local(known, 3)
        if shard.num_rows and len(local.grams):
            text, base, used = narrowed(load_ids(shard.column("ids")[0].as_py()), local.grams)
            words = load_words(shard.column("words")[0].as_py()).take(pa.array(used))
            for found, number in phrases(text, base, len(used), longest):
                phrase.append(pc.binary_join_element_wise(*(words.take(pa.array(found[:, k])) for k in range(found.shape[1])), " "))
                n.append(number)
            lang = [shard.column("lang")[0].as_py()]
        size = sum(map(len, phrase))
        return pa.Table.from_arrays([pa.array(lang * size, pa.string()), pa.chunked_array(phrase), pa.array(np.concatenate(n))], ["lang", "phrase", "n"])

    return parts.select("shard", "lang", "ids", "words").groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(run, "lang string, phrase string, n long")


#: Whether Spark removes an execution's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tidily(df: DataFrame, name: str) -> DataFrame:
    """``written``; the shuffle files of it go at once, since nothing but the written table is read again."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return written(df, name)
    finally:
        conf.set(CLEANUP, before)


def spelled(grams: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """(lang, phrase, f) of frequent pairs or triples."""
    f = grams.where("shard is null").select(F.explode(F.arrays_zip(*keys, "totals")).alias("x"), "last")
    f = f.select(*[F.col(f"x.{k}").alias(k) for k in keys], "last", F.col("x.totals").alias("f"))
    for c in (*keys, "last"):
        f = f.join(words.select(F.col("word_id").alias(c), F.col("word").alias(f"w_{c}"), *(["lang"] if c == "last" else [])), c)
    return f.select("lang", F.concat_ws(" ", *(f"w_{c}" for c in (*keys, "last"))).alias("phrase"), "f")


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of every phrase of 1 to ``longest`` words that occurs ``min_count`` times, (lang, n) of all words)."""
    parts = written(shards(docs), "shards")
    # of one word all rows get one number: that of a shard which has it
    own = F.min(F.shiftleft("shard", WORD_BITS) + F.col("id")).over(Window.partitionBy("word", "lang")).alias("word_id")
    known = tidily(frequent(word_counts(parts), ["word", "lang"], min_count).select("shard", "id", "lang", "word", "total", own), "known_words")
    words = tidily(known.groupBy("word_id").agg(F.first("lang").alias("lang"), F.first("word").alias("word"), F.first("total").alias("f")), "frequent_words")
    found = [words.select("lang", F.col("word").alias("phrase"), "f")]
    if longest > 1:
        pairs = tidily(summed(pair_lists(parts, known), PAIR, min_count), "known_pairs")
        found.append(spelled(pairs, words, PAIR))
    if longest > 2:
        triples = tidily(summed(triple_lists(parts, with_words(pairs, known)), TRIPLE, min_count), "known_triples")
        found.append(spelled(triples, words, TRIPLE))
    if longest > 3:
        more = phrase_counts(parts, with_words(triples, known), longest)
        found.append(more.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count))
    table = reduce(DataFrame.unionByName, found).withColumn("size", F.size(F.split("phrase", " ", -1)))
    return tidily(table, "phrases"), parts.groupBy("lang").agg(F.sum("n_words").alias("n"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, first: int = FIRST) -> DataFrame:
    """Each language's ``first`` phrases of 2 to ``longest`` words by how much oftener they occur than their parts would together.

    Input: ``lang``, ``text``; other columns, whatever their names, aren't read.  Output: ``lang`` (null: und),
    ``rank`` (from 1), ``phrase``, ``a`` (its count), ``l`` and ``r`` (counts of the two parts it is cut
    into), ``n`` (all words of the language), ``score`` = floor(1000 a n / (l r)) of the cut
    that scores lowest; ties go to the cut that comes first.  Phrases that never occur but
    inside a longer one are left out.  Null and empty texts have no words; repeated rows count each
    time; ties in score go to the larger count, then to the smaller phrase by its bytes; no words, no rows.
    """
    table, totals = frequent_phrases(docs, min_count, longest)
    # a longer phrase with the same count, by one word: then all between them have it too
    longer = table.where("size > 2").select("lang", F.split("phrase", " ", -1).alias("w"), "f", "size")
    sides = F.array(F.array_join(F.slice("w", 1, F.col("size") - 1), " "), F.array_join(F.slice("w", 2, F.col("size") - 1), " "))
    inside = longer.select("lang", F.explode(sides).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    own = table.where("size > 1").join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("f")))
    cuts = own.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("p"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("q"))
    part = table.select("lang", "phrase", "f")
    cuts = cuts.join(part.toDF("lang", "p", "l"), ["lang", "p"]).join(part.toDF("lang", "q", "r"), ["lang", "q"]).join(totals, "lang")
    big = "cast(a * 1000L as decimal(19, 0)) * cast(n as decimal(18, 0)) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"
    scored = cuts.withColumn("score", F.expr(big))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("m"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("m.score"), F.desc("m.a"), "phrase"))
    top = lowest.withColumn("rank", rank).where(F.col("rank") <= first)
    return top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *[F.col(f"m.{c}").alias(c) for c in ("a", "l", "r", "n", "score")])

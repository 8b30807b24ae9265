"""Spelling variants: words one insertion, deletion or replacement apart, found with grams of variable length.

1. Words are counted over all texts, combined in each task first.
2. The gram dictionary is pruned by frequency: a gram of the words that occurs more than a threshold is
   not selective, so a longer gram that starts with it is used instead, up to ``QMAX``.  The
   threshold grows with the words, so that at most ``DICTIONARY`` grams of a length lie above it.
3. A word, with a mark at either end, is decomposed: at each place starts the shortest gram that isn't
   too frequent.  A gram depends on nothing but the characters it spans.  So an edit affects
   just the grams that span it, and a word's bound is the largest number of its grams that
   span one character.  Two words one edit apart share all grams but these.
4. Of a word's lists (the words with a gram at a place) hence only bound + 1 must be merged, and the
   rarest are taken.  One order of all grams makes that hold for both words of a pair, so the
   merge is a join of those few grams: on the gram and its distance from the word's start, or from
   its end if the lengths differ.
5. Every pair that meets is verified by its edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.bpe import few
from rowmill.llm.common import binary, id_text, saved, written

QMIN, QMAX = 2, 5
#: Grams of a length that the dictionary holds at most, and the least threshold of frequency.
DICTIONARY = 50_000
LEAST_FREQUENT = 30
#: Counters of gram frequencies by hash, which order the grams.  Any order gives the same pairs.
SLOTS = 1 << 17
#: Different words or grams that a task counts before it passes them on.
COUNT_ENTRIES = 300_000
#: Longer words are verified apart.
LONG = 64
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
#: Fixed value: one in so many occurrences is disturbed.
DISTURBED = 199
START, END = "\x02", "\x03"


def counted(batches: Iterator[Iterable[tuple[str, int]]], names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Batches of (text, n), summed while they are few enough."""
    total: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], list(names))

    for pairs in batches:
        for text, n in pairs:
            total[text] += n
        if len(total) >= COUNT_ENTRIES:
            yield out()
            total.clear()
    if total:
        yield out()


def disturbed(run: bytes, h: int) -> bytes:
    """``run`` without its code point ``h % length``."""
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def runs(doc_id: int | None, text: bytes, pattern: re.Pattern[bytes], min_chars: int) -> Iterator[tuple[bytes, int]]:
    """(word, n) of a text's runs, disturbed ones as they are then.  A null id counts as no digits."""
    before = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for run, n in Counter(pattern.findall(text.lower())).items():  # bytes.lower() changes A-Z alone
        h = zlib.crc32(run, before)
        if h % DISTURBED:
            yield run, n
        elif len(word := disturbed(run, h)) - word.count(b"\xc3") >= min_chars:
            yield word, n


def words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_chars`` code points that occur ``min_count`` times or more."""
    # letters of Latin-1 are C3 80 to C3 BF in UTF-8; a run long enough is always matched whole
    source = rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % min_chars

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(source)
        found = (
            ((w.decode(), n) for doc, text in zip(b.column("doc_id").to_pylist(), binary(b.column("text"))) for w, n in runs(doc, text, pattern, min_chars))
            for b in few(batches)
        )
        return counted(found, ("word", "n"))

    each = id_text(docs).mapInArrow(count, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def marked(word: str) -> str:
    return START + word + END


def gram_counts(vocabulary: DataFrame) -> DataFrame:
    """(gram, n) for all grams of QMIN to QMAX characters of the marked words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grams(batch: pa.RecordBatch) -> Iterator[tuple[str, int]]:
            for w in batch.column("word").to_pylist():
                s = marked(w)
                for q in range(QMIN, QMAX + 1):
                    for p in range(len(s) - q + 1):
                        yield s[p : p + q], 1

        return counted((grams(b) for b in batches), ("gram", "n"))

    return vocabulary.mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class GramDictionary:
    """Grams that occur too often to be used (bounded by ``DICTIONARY`` a length), and the order of all."""

    def __init__(self, frequent: Iterable[str], slots: np.ndarray):
        self.frequent, self.slots = frozenset(frequent), slots

    def decompose(self, word: str) -> list[tuple[int, str]]:
        """(place, gram) at each place of the marked word."""
        s, frequent = marked(word), self.frequent
        out = []
        for p in range(len(s) - QMIN + 1):
            q = p + QMIN
            while q - p < QMAX and q < len(s) and s[p:q] in frequent:
                q += 1
            out.append((p, s[p:q]))
        return out

    def affected(self, grams: list[tuple[int, str]]) -> int:
        """The most grams that one edit can affect: those that span one character of the word."""
        n = len(grams) + QMIN - 1
        change = [0] * (n + 1)
        for p, g in grams:
            change[p] += 1
            change[p + len(g)] -= 1
        most = depth = 0
        for at, step in enumerate(change[: n - 1]):
            depth += step
            if at:  # the marks themselves are never edited
                most = max(most, depth)
        return most

    def lists(self, word: str) -> list[tuple[int, str]]:
        """The bound + 1 rarest grams: any word one edit away has one of them, aligned, among its own."""
        grams = self.decompose(word)
        rare = sorted((int(self.slots[zlib.crc32(g.encode()) % SLOTS]), g, p) for p, g in grams)
        return [(p, g) for _, g, p in rare[: self.affected(grams) + 1]]


def gram_dictionary(vocabulary: DataFrame) -> GramDictionary:
    counts = written(gram_counts(vocabulary), "grams")
    total = counts.where(F.length("gram") == QMIN).agg(F.sum("n")).first()[0] or 0
    threshold = max(LEAST_FREQUENT, -(-total // DICTIONARY))
    frequent = counts.where((F.col("n") > threshold) & (F.length("gram") < QMAX)).select("gram").collect()  # fewer than DICTIONARY of each length
    slots = np.zeros(SLOTS, np.int64)
    slot = (F.crc32(F.col("gram").cast("binary")) % F.lit(SLOTS)).alias("slot")
    for r in counts.groupBy(slot).agg(F.sum("n").alias("n")).collect():  # at most SLOTS rows
        slots[r["slot"]] = r["n"]
    return GramDictionary((r["gram"] for r in frequent), slots)


def one_edit(a: str, b: str) -> bool:
    """Whether ``b``, as long as ``a`` or longer by one, is one replacement or insertion away; in time n log n."""
    low, high = 0, len(a)
    while low < high:  # the longest common beginning
        k = (low + high + 1) // 2
        low, high = (k, high) if a[:k] == b[:k] else (low, k - 1)
    return a != b and a[low + (len(a) == len(b)) :] == b[low + 1 :]


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([one_edit(a, b) for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())], pa.bool_()))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, na, b, nb): each unordered pair of words that are one edit apart, once.  Words must have at least
    QMAX characters, so that some gram is always unaffected."""
    spark = vocabulary.sparkSession
    shared = spark.sparkContext.broadcast(gram_dictionary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            key, left, word, count = [], [], [], []
            for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                for p, g in own.lists(w):
                    for side, at in ((True, p), (False, len(w) - p)):
                        key.append(xxhash.xxh3_64_intdigest(f"{side:d}{at}:{g}".encode()) - (1 << 63))
                        left.append(side)
                        word.append(w)
                        count.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(left, pa.bool_()), pa.array(word, pa.string()), pa.array(count, pa.int64()), pa.array([len(w) for w in word], pa.int32())],
                ["key", "from_start", "word", "n", "size"])

    lists = written(vocabulary.mapInArrow(run, "key long, from_start boolean, word string, n long, size int"), "lists")
    a, b = lists.alias("a"), lists.alias("b")
    longer = F.col("b.size") == F.col("a.size") + 1
    other = F.col("a.from_start") & (F.col("a.size") == F.col("b.size")) & (F.col("a.word") < F.col("b.word"))
    meet = (F.col("a.key") == F.col("b.key")) & (longer | other)
    columns = [F.col("a.word").alias("a"), F.col("a.n").alias("na"), F.col("b.word").alias("b"), F.col("b.n").alias("nb")]
    short = (F.col("a.size") <= LONG) & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
    pairs = a.join(b, meet & short).select(*columns)
    long = lists.where(F.col("size") > LONG)
    # the built-in distance takes time by the square of such words
    rest = long.alias("a").join(long.alias("b"), meet).select(*columns).distinct().mapInArrow(verified, "a string, na long, b string, nb long")
    return pairs.distinct().unionByName(rest)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, twice as far each round."""
    now = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = saved(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """Words and the frequent spelling each may stand for.

    Input: ``doc_id``, ``text``; other columns, whatever their names, aren't read.  Output, one row per word:
    ``word``, ``form`` (its near word that occurs most, if ``ratio`` times as often as the word; of
    equally frequent ones the smallest), ``root`` (where the forms end; the word itself without
    one), ``n``, ``n_near``, ``form_n``.  Null and empty texts have no words; a null id counts as no
    digits where occurrences are disturbed; repeated rows count each time; no words, no rows.  A form occurs
    more often than its word, so following forms always ends.
    """
    if min_chars < QMAX:
        raise ValueError(f"words need at least {QMAX} characters")
    vocabulary = written(words(docs, min_chars, min_count), "words")
    pairs = written(near_pairs(vocabulary), "near")
    both = pairs.toDF("word", "n", "near", "near_n").unionByName(pairs.toDF("near", "near_n", "word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    found = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = written(vocabulary.join(found, "word", "left"), "variants")
    far = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    formed = found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(far, F.col("best.near")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"))
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

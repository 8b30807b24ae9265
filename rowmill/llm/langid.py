"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed.  A pass over all documents that may be learnt
from counts in how many each hash occurs.  A bounded sample trains the weights by
follow-the-regularised-leader with elastic-net penalties; a part of it, kept back, sets the
temperature that calibrates the probabilities.  A text's score is a sum over its n-grams,
so whole texts cost one look-up an n-gram.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.bpe import few
from rowmill.llm.common import id_text, some_rows, strings
from rowmill.llm.quality import fold

BITS = 16
ORDERS = 3
#: Documents that the weights are fitted on at most, whatever the corpus' size; but ``LEAST`` of each language,
#: or all that it has.
SAMPLE, LEAST = 2400, 40
#: Languages that are told apart at most: the most frequent.
LANGUAGES = 500
#: Every so-many-th document of the sample sets the temperature.
CALIBRATION = 4
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(k).isalpha() for k in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str) -> np.ndarray | None:
    """Hashes of all n-grams of the lower-cased text, all but letters read as spaces; None without letters."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    own = letters()[c]
    if not own.any():
        return None
    c = np.where(own, c, np.uint32(32))
    c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]]).astype(np.uint32)
    out, h = [], np.zeros(len(c), np.uint32)
    for k in range(ORDERS):
        h = (h[: len(c) - k] * np.uint32(0x01000193)) ^ c[k:] if k else c
        out.append((h + np.uint32(k)) * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS))
        h = h[:-1]
    return np.concatenate(out)


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that may be learnt from."""
    return docs.where(fold(FOLDS) != HELD_OUT).where("lang is not null")


def document_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each hash occurs, and the number of documents with letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << BITS, np.int64), 0
        for batch in few(batches):
            for text in strings(batch.column("text")):
                if (own := grams(text)) is not None:
                    seen = np.zeros(1 << BITS, np.int8)
                    seen[own] = 1
                    total += seen
                    n += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))], ["gram", "n"])

    out, n = np.zeros(1 << BITS, np.int64), 0
    for r in docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():  # at most 2^BITS + 1 rows
        if r["gram"] < 0:
            n = r["n"]
        else:
            out[r["gram"]] = r["n"]
    return out, n


def sample_rows(docs: DataFrame, size: int, least: int = LEAST) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, hashes, term frequencies) of at most ``size`` rows, chosen by a hash of the row, and of rows of
    languages that have fewer than ``least`` among them, up to ``least`` each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            rows = []
            for lang, text in zip(batch.column("lang").to_pylist(), strings(batch.column("text"))):
                if (own := grams(text)) is not None:
                    g, n = np.unique(own, return_counts=True)
                    rows.append((lang, g.astype("<u4").tobytes(), (n / len(own)).astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.binary(), pa.binary()))], ["lang", "g", "tf"])

    def collected(rows: DataFrame) -> list[tuple[str, bytes, bytes]]:
        rows = rows.select("lang", "text").mapInArrow(run, "lang string, g binary, tf binary").collect()
        return [(r["lang"], bytes(r["g"]), bytes(r["tf"])) for r in rows]

    key = F.xxhash64("doc_id", F.xxhash64("text"))
    chosen = collected(some_rows(docs, size, key))
    have = Counter(lang for lang, _, _ in chosen)
    langs = [r["lang"] for r in docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()]
    few_rows = [x for x in langs if have[x] < least]
    if few_rows:
        place = F.row_number().over(Window.partitionBy("lang").orderBy(key))
        rare = docs.where(F.col("lang").isin(few_rows)).withColumn("__r", place).where(F.col("__r") <= least)
        chosen = [r for r in chosen if r[0] not in set(few_rows)] + collected(rare)
    known = set(langs)
    return sorted(r for r in chosen if r[0] in known)


class Model:
    def __init__(self, langs: list[str], idf: np.ndarray):
        self.langs, self.idf = langs, idf
        self.weight = np.zeros((1 << BITS, len(langs)), np.float32)
        self.bias = np.zeros(len(langs))
        self.temperature = 1.0

    def fit(self, rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 4, alpha: float = 2.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4) -> None:
        """Follow the regularised leader, a rate for each weight; l1 leaves most weights at zero."""
        size = len(self.langs)
        z = np.zeros(((1 << BITS) + 1, size))
        n = np.zeros_like(z)

        def weights(at: np.ndarray) -> np.ndarray:
            own, seen = z[at], n[at]
            w = -(own - np.sign(own) * l1) / ((beta + np.sqrt(seen)) / alpha + l2)
            return np.where(np.abs(own) <= l1, 0.0, w)

        rng = np.random.default_rng(7)
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                y, g, x = rows[k]
                at = np.append(g, 1 << BITS)
                x = np.append(x, 1.0)
                w = weights(at)
                s = x @ w
                p = np.exp(s - s.max())
                p /= p.sum()
                p[y] -= 1
                grad = x[:, None] * p
                z[at] += grad - (np.sqrt(n[at] + grad * grad) - np.sqrt(n[at])) / alpha * w
                n[at] += grad * grad
        every = weights(np.arange((1 << BITS) + 1))
        self.weight[:], self.bias = every[:-1], every[-1]

    def calibrate(self, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        """The temperature of least log loss on rows not trained on."""
        if not rows:
            return
        s = np.stack([x @ self.weight[g] + self.bias for _, g, x in rows])
        y = np.array([r[0] for r in rows])

        def loss(t: float) -> float:
            a = s / t
            a = a - a.max(1, keepdims=True)
            return float((np.log(np.exp(a).sum(1)) - a[np.arange(len(y)), y]).mean())

        self.temperature = min(np.geomspace(0.05, 20, 120), key=loss)

    def freeze(self) -> "Model":
        """Fold the IDF into the weights, for scoring."""
        self.table = (self.weight * self.idf[:, None]).astype(np.float32)
        return self

    def predict(self, text: str) -> tuple[str, float]:
        own = grams(text)
        if own is None or not self.langs:
            return UNKNOWN, 0.0
        s = np.zeros(len(self.langs))
        for at in range(0, len(own), 1 << 16):
            s += self.table[own[at : at + (1 << 16)]].sum(0, dtype=np.float64)
        s = (s / len(own) + self.bias) / self.temperature
        p = np.exp(s - s.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from rows (doc_id, text, lang) outside the held-out fold whose lang isn't null."""
    own = learnable(docs)
    seen, n = document_counts(own)
    idf = np.log((1 + n) / (1 + seen)) + 1
    rows = [(lang, np.frombuffer(g, "<u4").astype(np.int64), np.frombuffer(tf, "<f4").astype(float)) for lang, g, tf in sample_rows(own, sample)]
    langs = sorted({r[0] for r in rows})
    model = Model(langs, idf)
    rows = [(langs.index(lang), g, tf * idf[g]) for lang, g, tf in rows]
    order = np.random.default_rng(3).permutation(len(rows))
    kept = [rows[k] for k in order[::CALIBRATION]] if len(rows) >= 40 else []
    used = [rows[k] for i, k in enumerate(order) if i % CALIBRATION or not kept]
    model.fit(used)
    model.calibrate(kept)
    return model.freeze()


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Predict the language of every text.

    Input: ``doc_id``, ``text``, ``lang`` (null: unknown, not learnt from).  Output, one row per input
    row: ``doc_id``, ``held_out`` (crc32 of the id as text leaves 2 by 4; a null id counts as empty
    text), ``lang_pred``, ``score``.  Texts that are null or have no letter are ``und`` with score 0,
    and so are all if there is nothing to learn from.  An empty table gives no rows.
    """
    texts = id_text(docs).withColumn("lang", F.lit(None).cast("string"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    shared = docs.sparkSession.sparkContext.broadcast(train(own, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            found = [shared.value.predict(t) for t in strings(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    out = texts.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")

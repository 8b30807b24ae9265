"""Quality classifier learnt from positive and unlabelled documents.

One pass over the texts turns each into a few shape figures (shares of character classes,
repetition of words and lines).  A bounded sample of rows labelled good and of rows without
regard to labels trains a linear model on binned figures by non-negative unbiased risk:
with class prior p and sigmoid loss l(z) = 1 / (1 + exp(z)),

    p E_good[l(g)] + max(0, E_unlabelled[l(-g)] - p E_good[l(-g)]).

The prior is estimated from the same two samples: where scores are high, the share of
unlabelled rows over the share of good ones tends to it from above.  The score is the
posterior p f_good(g) / f_unlabelled(g), made monotone over bins of g.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.bpe import few
from rowmill.llm.common import binary, id_text, some_rows, written

#: Rows of each kind that a model is fitted on at most, whatever the corpus' size.
SAMPLE = 6000
FOLDS, HELD_OUT = 5, 0
CUT = 0.3
_LETTER = np.zeros(256)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_UPPER = np.zeros(256)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256)
_DIGIT[48:58] = 1
_BLANK = np.zeros(256)
_BLANK[[9, 10, 11, 12, 13, 32]] = 1
_STOP = np.zeros(256)
_STOP[[ord(c) for c in ".,;:?'\"-()"]] = 1
_SIGN = 1 - np.minimum(1, _LETTER + _DIGIT + _BLANK + _STOP)
_CLASSES = np.stack([_LETTER, _UPPER, _DIGIT, _BLANK, _STOP, _SIGN], 1)
FIGURES = 14


def figures(text: bytes) -> list[float]:
    """Shape of a text: the whole of it counts, whatever its length."""
    n = len(text)
    if not n:
        return [0.0] * FIGURES
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letter, upper, digit, blank, stop, sign = count @ _CLASSES
    share = count[count > 0] / n
    words = text.split()
    w = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x]
    distinct = len(set(words))
    return [
        np.log1p(n), np.log1p(len(words)), letter / n, upper / max(1, letter), digit / n, blank / n, stop / n, sign / n,
        float(-(share * np.log(share)).sum()), (n - blank) / w, distinct / w, np.log1p(distinct) / np.log1p(w),
        sum(map(eq, words, words[1:])) / w, len(set(lines)) / max(1, len(lines)),
    ]


def shapes(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the figures of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            x = [figures(t) for t in binary(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float32()))], ["doc_id", "x"])

    return docs.mapInArrow(run, "doc_id long, x array<float>")


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Model:
    """Linear in the bins of each figure."""

    MARKS = (0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995, 0.998)

    def __init__(self, x: np.ndarray):
        self.edges = [np.unique(np.quantile(x[:, k], self.MARKS)) for k in range(x.shape[1])]
        self.first = np.cumsum([0, *(len(e) + 1 for e in self.edges)])
        self.weight = np.zeros(self.first[-1])
        self.bias = 0.0
        self.knots, self.posterior = np.array([0.0]), np.array([0.5])

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Column of each figure's bin."""
        return np.stack([self.first[k] + np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1)

    def raw(self, bins: np.ndarray) -> np.ndarray:
        return self.weight[bins].sum(1) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        g = self.raw(self.bins(x))
        return 0.999 * np.interp(g, self.knots, self.posterior) + 0.001 * logistic(g)  # the rest orders equal posteriors

    def calibrate(self, good: np.ndarray, free: np.ndarray, prior: float) -> None:
        """Posterior over bins of the raw score, made monotone by pooling neighbours (weights: rows)."""
        every = np.concatenate([good, free])
        edges = np.unique(np.quantile(every, np.linspace(0, 1, 101)[1:-1]))
        a = np.bincount(np.searchsorted(edges, good, "right"), minlength=len(edges) + 1)
        b = np.bincount(np.searchsorted(edges, free, "right"), minlength=len(edges) + 1)
        middle = np.concatenate([edges[:1], (edges[1:] + edges[:-1]) / 2, edges[-1:]]) if len(edges) else np.zeros(1)
        pools: list[list[float]] = []  # weighted posterior, weight, bins
        for x, y in zip(a, b):
            pools.append([prior * x / len(good), y / len(free), 1])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                last = pools.pop()
                pools[-1] = [p + q for p, q in zip(pools[-1], last)]
        self.knots = middle
        self.posterior = np.repeat([min(1.0, p / q) if q else 1.0 for p, q, _ in pools], [int(n) for *_, n in pools])

    def descend(self, good: np.ndarray, free: np.ndarray, prior: float | None, rounds: int = 400, rate: float = 0.05, decay: float = 1e-4) -> None:
        """Minimise the risk by Adam; prior None: plain good against unlabelled."""
        size = len(self.weight) + 1
        m, v = np.zeros(size), np.zeros(size)
        if prior is None:
            self.weight[:], self.bias = 0, 0.0
        for t in range(1, rounds + 1):
            a, b = self.raw(good), self.raw(free)
            # logistic loss without a prior; else of the sigmoid loss, l(z)' = -s(z) s(-z) = -l(-z)'
            if prior is None:
                on_good, on_free = (logistic(a) - 1) / len(a), logistic(b) / len(b)
            else:
                slope_a, slope_b = logistic(a) * logistic(-a), logistic(b) * logistic(-b)
                if logistic(b).mean() >= prior * logistic(a).mean():
                    on_good, on_free = -2 * prior * slope_a / len(a), slope_b / len(b)
                else:  # step back out of the negative part
                    on_good, on_free = prior * slope_a / len(a), -slope_b / len(b)
            grad = np.zeros(size)
            for rows, part in ((good, on_good), (free, on_free)):
                grad[:-1] += np.bincount(rows.ravel(), np.repeat(part, rows.shape[1]), size - 1)
                grad[-1] += part.sum()
            grad[:-1] += decay * self.weight
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
            self.weight -= step[:-1]
            self.bias -= step[-1]


def class_prior(good: np.ndarray, free: np.ndarray) -> float:
    """Share of good rows among the unlabelled, from scores of rows not trained on: the least ratio of
    upper tails, with a margin of one standard error for its noise."""
    best = 1.0
    for t in np.quantile(good, np.linspace(0.02, 0.6, 30)):
        a, b = (good >= t).mean(), (free >= t).mean()
        noise = np.sqrt(b * (1 - b) / len(free)) / a
        best = min(best, b / a + noise)
    return float(np.clip(best, 0.02, 0.98))


def fit(good: np.ndarray, free: np.ndarray) -> tuple[Model, float]:
    """Model and estimated prior."""
    model = Model(np.concatenate([good, free]))
    p, u = model.bins(good), model.bins(free)
    model.descend(p[::2], u[::2], None, 200)
    prior = class_prior(model.raw(p[1::2]), model.raw(u[1::2])) if min(len(p), len(u)) > 1 else 0.5
    model.descend(p, u, None, 200)
    model.descend(p, u, prior)
    model.calibrate(model.raw(p), model.raw(u), prior)
    return model, prior


def fold(folds: int):
    """crc32 of the id as text (null: empty), by the number of folds."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def train(x: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Model, float] | None:
    """Fit on stored figures.  Only rows outside the held-out fold are read; of the labels, only which
    rows are good.  None if there is none."""
    x = x.where(fold(FOLDS) != HELD_OUT)
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long")).distinct()
    some = lambda df: [r["x"] for r in some_rows(df, sample, F.xxhash64("doc_id", "x")).select("x").collect()]
    a, b = some(x.join(good, "doc_id")), some(x)
    if not a:
        return None
    return fit(np.array(a, float), np.array(b, float))


def scored(x: DataFrame, model: Model | None) -> DataFrame:
    """Add ``score`` to rows with figures ``x``; 0.5 without a model."""
    if model is None:
        return x.withColumn("score", F.lit(0.5))
    shared = x.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, FIGURES).astype(float)
            yield batch.append_column("score", pa.array(shared.value.score(own), pa.float64()))

    return x.mapInArrow(run, "doc_id long, x array<float>, score double")


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Probability that each document is good.

    Input: ``docs`` (doc_id, text), ``labels`` (doc_id, quality; other values than 1 and nulls say
    nothing).  Output, one row per input row: ``doc_id``, ``held_out`` (crc32 of the id as text is
    divisible by 5), ``score``, ``predicted`` (score >= 0.3).  Null and empty texts are scored as
    texts without characters; a null id counts as empty text.  Without good labels every score
    is 0.5.  An empty table gives no rows.
    """
    x = written(shapes(id_text(docs)), "shapes")
    found = train(x, labels, sample)
    out = scored(x, found and found[0])
    return out.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose score reaches the cut, all columns as they were."""
    found = train(written(shapes(id_text(docs)), "shapes"), labels, sample)
    if found is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(found[0])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            x = np.array([figures(t) for t in binary(batch.column(at))], np.float32).reshape(-1, FIGURES)
            yield batch.filter(pa.array(shared.value.score(x.astype(float)) >= CUT))

    return docs.mapInArrow(run, docs.schema)

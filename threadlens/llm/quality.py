"""Quality classifier: a factorisation machine over hashed words, structure
statistics and text metadata.

Score = w0 + sum(w_i x_i) + 1/2 sum_f [ (sum v_if x_i)^2 - sum v_if^2 x_i^2 ]:
the sum-of-squares identity gives all pairwise interactions in time linear in
the features.  A document's features are its distinct words, hashed, and one
bin for each structure statistic (repetition, capitals, symbols, line shape)
and each piece of metadata (bytes, characters, words).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import broadcast_fields, sigmoid, text_score
from threadlens.llm.sampling import held_out, labelled_sample

WORD_BUCKETS = 1 << 15
BINS = 8
RANK = 8
SAMPLE = {0: 3_000, 1: 5_000}
#: Passes over the sample: at least 8, more for a small one.
EPOCHS, UPDATES = 8, 20_000
RATE = 0.15
WORD_WEIGHT = 0.7
STAT_WEIGHT = 0.5
THRESHOLD = 0.7
CACHE_WORDS = 500_000
_UPPER = bytes(range(65, 91))
_DIGIT = b"0123456789"
_SYMBOL = b"#$%&*+/<=>@[\\]^_`{|}~"
_SHOUT = b"!"
STATS = ("bytes", "chars", "words", "distinct", "word_bytes", "repeats", "upper", "digits", "symbols", "shouts",
         "lines", "line_words")


@dataclass(frozen=True)
class QualityModel:
    cuts: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray


class Buckets(dict):
    """word -> bucket; a cache of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word) % WORD_BUCKETS
        return value


def measured(text: str | None, buckets: Buckets) -> tuple[np.ndarray, list[float]]:
    """(hashed distinct words, statistics) of a whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    distinct = set(words)
    n, m = max(1, len(raw)), max(1, len(words))
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    lines = raw.count(b"\n") + 1
    stats = [np.log1p(len(raw)), np.log1p(len(text)), np.log1p(len(words)), len(distinct) / m,
             np.log1p(len(raw) / m), sum(map(eq, words, words[1:])) / m, share(_UPPER), share(_DIGIT),
             share(_SYMBOL), share(_SHOUT), lines / m, np.log1p(len(words) / lines)]
    ids = np.fromiter({buckets[w.lower()] for w in distinct}, np.int64)
    ids.sort()
    return ids, stats


def gathered(items: list[tuple[np.ndarray, list[float]]], cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids, their values and where each document starts."""
    if not items:
        return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
    bins = np.stack([np.searchsorted(cuts[s], [stats[s] for _, stats in items], side="right")
                     for s in range(len(STATS))], axis=1)
    bins = bins + WORD_BUCKETS + np.arange(len(STATS)) * BINS
    ids, values = [], []
    for (words, _), b in zip(items, bins):
        ids += [b, words]
        values += [np.full(len(b), STAT_WEIGHT), np.full(len(words), WORD_WEIGHT / np.sqrt(max(1, len(words))))]
    starts = np.cumsum([0] + [len(w) + len(STATS) for w, _ in items])[:-1]
    return np.concatenate(ids), np.concatenate(values), starts


def margin(model: QualityModel, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The machine's output in time linear in the features."""
    if not len(starts):
        return np.empty(0)
    vx = model.factors[ids] * x[:, None]
    total = np.add.reduceat(vx, starts)
    squares = np.add.reduceat((vx * vx).sum(1), starts)
    return model.bias + np.add.reduceat(model.linear[ids] * x, starts) + 0.5 * ((total * total).sum(1) - squares)


def fit(items: list[tuple[np.ndarray, list[float]]], y: np.ndarray, epochs: int | None = None, seed: int = 7) -> QualityModel:
    """Adagrad on the logistic loss, in seeded batches; no texts, no bias."""
    rng = np.random.default_rng(seed)
    epochs = epochs or max(EPOCHS, min(60, UPDATES // max(1, len(items))))
    table = np.array([s for _, s in items]).reshape(-1, len(STATS)) if items else np.zeros((1, len(STATS)))
    cuts = np.quantile(table, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    size = WORD_BUCKETS + BINS * len(STATS)
    bias, linear = 0.0, np.zeros(size)
    factors = rng.normal(0, 0.05, (size, RANK))
    g_bias, g_lin, g_fac = 1e-8, np.full(size, 1e-2), np.full((size, RANK), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(items))
        for at in range(0, len(order), 128):
            part = order[at:at + 128]
            ids, x, starts = gathered([items[i] for i in part], cuts)
            model = QualityModel(cuts, bias, linear, factors)
            err = sigmoid(margin(model, ids, x, starts)) - y[part]
            lengths = np.diff(np.r_[starts, len(ids)])
            doc = np.repeat(np.arange(len(part)), lengths)
            vx = factors[ids] * x[:, None]
            total = np.add.reduceat(vx, starts)
            weight = (err[doc] * x / len(part) * 16)
            rows, where = np.unique(ids, return_inverse=True)
            d_lin = np.bincount(where, weight, len(rows)) + 1e-4 * linear[rows]
            d_fac = np.zeros((len(rows), RANK))
            np.add.at(d_fac, where, weight[:, None] * (total[doc] - vx))
            d_fac += 1e-4 * factors[rows]
            g_lin[rows] += d_lin ** 2
            g_fac[rows] += d_fac ** 2
            linear[rows] -= RATE * d_lin / np.sqrt(g_lin[rows])
            factors[rows] -= RATE * 0.3 * d_fac / np.sqrt(g_fac[rows])
            d = err.sum() / len(part) * 16
            g_bias += d * d
            bias -= RATE * d / np.sqrt(g_bias)
    return QualityModel(cuts, float(bias), linear, factors)


def train(docs: DataFrame, labels: DataFrame, seed: str = "quality") -> QualityModel:
    """Fit on a bounded sample: at most ``SAMPLE`` labelled texts (3,000 of low
    quality, 5,000 of high)."""
    sample = labelled_sample(docs, labels, "quality", seed, SAMPLE)
    buckets = Buckets()
    return fit([measured(t, buckets) for t, _ in sample], np.array([float(q) for _, q in sample]))


def score_column(docs: DataFrame, model: QualityModel) -> Column:
    """The score of each row's whole text: the odds of label 1.

    Defined cases: a null text is scored as the empty one, which has no words
    and the statistics of nothing; repeated rows get equal scores."""
    shared = broadcast_fields(docs.sparkSession, model)

    def setup():
        m, buckets = QualityModel(*shared.value), Buckets()

        def parts(texts) -> Iterator[np.ndarray]:
            held, weight = [], 0
            for t in texts:
                held.append(measured(t, buckets))
                weight += len(held[-1][0]) + len(STATS)
                if weight > 200_000:
                    yield sigmoid(margin(m, *gathered(held, m.cuts)))
                    held, weight = [], 0
            yield sigmoid(margin(m, *gathered(held, m.cuts)))

        return lambda texts: np.concatenate(list(parts(texts)))
    return text_score(setup)(F.col("text").cast("string"))


def learnable(labels: DataFrame) -> DataFrame:
    """Label rows that may be learnt from: those outside the held-out quarter."""
    return labels.filter(~held_out(4, 2))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, learnable(labels))
    return docs.select("doc_id", held_out(4, 2).alias("held_out"), score_column(docs, model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def only_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, that are scored good."""
    return docs.filter(score_column(docs, train(docs, learnable(labels))) >= THRESHOLD)

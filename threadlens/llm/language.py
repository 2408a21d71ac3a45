"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of a bounded sample per language; the matrix of log
probabilities (buckets x languages) is broadcast, and a batch of texts is
scored by gathering its rows and adding them up per text in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import broadcast_fields
from threadlens.llm.sampling import held_out, labelled_sample

BUCKETS = 1 << 15
ORDERS = (2, 3)
PER_LANGUAGE = 1_500
SMOOTH = 0.2
UNKNOWN = "und"
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    prior: np.ndarray
    log_prob: np.ndarray


def ngrams(text: str) -> np.ndarray:
    """Buckets of all character n-grams of a whole text, lower-cased; runs of
    white space count as one blank."""
    s = " " + " ".join(text.lower().split()) + " "
    c = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, h = [], np.zeros(len(c), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        n = len(c) - order + 1
        if n <= 0:
            break
        h = (h[:n] + c[order - 1:order - 1 + n] + np.uint64(order)) * _STEP
        h ^= h >> np.uint64(29)
        if order in ORDERS:
            out.append((h >> np.uint64(40)) % np.uint64(BUCKETS))
    return np.concatenate(out).astype(np.int64) if out else np.empty(0, np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def fit(sample: list[tuple[str, str]]) -> LanguageModel:
    """Counts with additive smoothing; equal priors for all languages."""
    languages = sorted({lang for _, lang in sample})
    counts = np.full((BUCKETS, len(languages)), SMOOTH)
    for text, lang in sample:
        counts[:, languages.index(lang)] += np.bincount(ngrams(text), minlength=BUCKETS)
    return LanguageModel(languages, np.zeros(len(languages)),
                         np.log(counts / counts.sum(0)).astype(np.float32))


def train(docs: DataFrame, seed: str = "language") -> LanguageModel:
    """Learn from a bounded sample of the rows of ``docs`` with a language: at
    most ``PER_LANGUAGE`` texts of each (1,500)."""
    known = docs.filter(F.col("lang").isNotNull())
    found = [r["lang"] for r in known.select("lang").distinct().collect()]
    labels = known.select("doc_id", "lang")
    return fit(labelled_sample(known, labels, "lang", seed, dict.fromkeys(found, PER_LANGUAGE)))


def predict(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """(language, posterior) of each text."""
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return langs, scores
    at, grams = [], []

    def flush():
        if at:
            starts = np.cumsum([0] + [len(g) for g in grams])[:-1]
            z = np.add.reduceat(model.log_prob[np.concatenate(grams)], starts, dtype=np.float64) + model.prior
            p = np.exp(z - z.max(1, keepdims=True))
            best = z.argmax(1)
            for i, b, s in zip(at, best, p[np.arange(len(at)), best] / p.sum(1)):
                langs[i], scores[i] = model.languages[b], s
            at.clear()
            grams.clear()

    held = 0
    for i, text in enumerate(texts):
        if has_letter(text):
            at.append(i)
            grams.append(ngrams(text))
            held += len(grams[-1])
            if held > 500_000:
                flush()
                held = 0
    flush()
    return langs, scores


def prediction_column(docs: DataFrame, model: LanguageModel) -> Column:
    """struct(lang_pred, score) of each row's whole text.

    Defined cases: ``und`` with score 0 for a null text, one without letters,
    or where nothing could be learnt; ties go to the first language by name."""
    shared = broadcast_fields(docs.sparkSession, model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = LanguageModel(*shared.value)
        for texts in batches:
            langs, scores = predict(texts.tolist(), model)
            yield pd.DataFrame({"lang_pred": pd.Series(langs, dtype="object"), "score": scores})
    return run(F.col("text").cast("string"))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learnt from the
    rows outside the held-out quarter."""
    model = train(docs.select("doc_id", "lang", "text").filter(~held_out(4, 2)))
    return docs.select("doc_id", held_out(4, 2).alias("held_out"), prediction_column(docs, model).alias("p")) \
        .select("doc_id", "held_out", "p.lang_pred", "p.score")

"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on what
toxic text adds to it: the parts of its words that mark it, in any script.  A text is cut into windows of a few words;
each window is compressed with the ordinary dictionary and with both together,
and the bytes that the toxic one saves are its distance.  Ordinary windows save
nothing, as the ordinary dictionary is in both.  A logistic curve over the
windows' savings turns them into a score; it is fitted across two halves of the
sample, each measured with the dictionaries of the other.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import broadcast_fields, sigmoid, text_score
from threadlens.llm.sampling import held_out, labelled_sample

WINDOW_WORDS = 8
LEVEL = 12
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 8_192
#: Windows that the ordinary dictionary is trained on, from all sampled texts.
ORDINARY_WINDOWS = 60_000
SEGMENT = 16
SAMPLE = {1: 2_000, 0: 4_000}
#: A mark of toxic text has 2 to 8 code points (in scripts without blanks two
#: are a word), this much evidence and this many times the share of the words.
GRAMS = (2, 8)
EVIDENCE = 20.0
TIMES = 4
MATCH = 3
#: The weight of the toxic class when the curve is fitted.
BALANCE = 0.4
RIDGE = 0.3
THRESHOLD = 0.7


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def windows(text: str | None, words: int = WINDOW_WORDS) -> list[bytes]:
    """Consecutive windows over the whole text, A-Z lower-cased."""
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return [b" ".join(w[i:i + words]) for i in range(0, len(w), words)]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


class Distance:
    """Bytes that the toxic dictionary saves on each window of a text."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.plain = compressor(ordinary)
        self.both = compressor(toxic + ordinary)

    def saved(self, text: str | None) -> np.ndarray:
        plain, both = self.plain.compress, self.both.compress
        return np.array([len(plain(w)) - len(both(w)) for w in windows(text)], np.float64)

    def features(self, text: str | None) -> list[float]:
        """The largest savings, how many windows save 2 to 8 bytes or more, and
        how large a share of the text they are."""
        d = np.sort(self.saved(text))[::-1]
        if not len(d):
            return [0.0] * 14
        many = np.array([float((d >= k).sum()) for k in range(2, 9)])
        return [d[0], d[:3].sum() / 3, d[:8].sum() / 8, *np.log1p(many), *np.sqrt(many[[0, 2]] / len(d)),
                np.maximum(d, 0).sum() / len(d), np.log1p(len(d))]


def _distinct(texts: list[str]) -> list[str]:
    """One text of each group of near copies (equal smallest shingle hash):
    copies would pass for frequent phrases."""
    seen, out = set(), []
    for t in texts:
        w = t.encode("utf-8", "surrogatepass").lower().split()
        h = min(xxhash.xxh3_64_intdigest(b" ".join(w[i:i + 5])) for i in range(max(1, len(w) - 4)))
        if h not in seen:
            seen.add(h)
            out.append(t)
    return out


def _words(text: str) -> set[str]:
    """The distinct words of a text, each between blanks."""
    return {f" {w} " for w in text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass").split()}


def evidence(n: int, of: int, other: int, others: int) -> float:
    """Log-likelihood ratio (chi-squared, one degree) of ``n`` among ``of``
    against ``other`` among ``others``."""
    def fit(k, size, p):
        return (k * math.log(p) if k else 0.0) + ((size - k) * math.log1p(-p) if size > k else 0.0)
    p = (n + other) / (of + others)
    return 2 * (fit(n, of, n / of) + fit(other, others, other / others) - fit(n, of, p) - fit(other, others, p))


def _grams(word: str, length: int, among=None) -> set[str]:
    found = {word[i:i + length] for i in range(len(word) - length + 1)}
    return found if among is None else {g for g in found if g in among}


def _held(words: dict[str, int], length: int, among=None, shorter=None) -> Counter:
    """How many of the counted ``words`` hold each gram of ``length`` code
    points: of those in ``among``, or of those whose two parts are ``shorter``."""
    out = Counter()
    for w, n in words.items():
        for g in _grams(w, length, among):
            if shorter is None or (g[1:] in shorter and g[:-1] in shorter):
                out[g] += n
    return out


def toxic_marks(toxic: list[str], ordinary: list[str]) -> set[str]:
    """The grams of ``GRAMS`` code points, blanks at a word's ends included,
    that tell toxic texts: by their shares of the texts' distinct words they
    have ``EVIDENCE`` and stand ``TIMES`` as often in toxic ones, and they are
    in as many toxic texts as can give that evidence by themselves.

    Marks are taken by evidence times the bytes that a match can save (none up
    to ``MATCH``), and each is judged by the words that no earlier one marks: part of a mark is not one by itself.  Their
    number is not bounded."""
    texts, there = defaultdict(list), Counter()
    for i, t in enumerate(toxic):
        for w in _words(t):
            texts[w].append(i)
    for t in ordinary:
        there.update(_words(t))
    here = {w: len(found) for w, found in texts.items()}
    of, others, whole = sum(here.values()), max(1, there.total()), max(1, len(ordinary))
    least = next((n for n in range(3, len(toxic)) if evidence(n, len(toxic), 0, whole) >= EVIDENCE),
                 max(1, len(toxic)))

    def told(n, other):
        enough = n >= least and n * others >= TIMES * (other + 0.5) * of
        return evidence(n, of, other, others) if enough else 0.0
    tells, shorter = {}, None
    for length in range(GRAMS[0], GRAMS[1] + 1):
        # a gram is in no more words than its parts
        shorter = {g: n for g, n in _held(here, length, shorter=shorter).items() if n >= least}
        usual = _held(there, length, among=shorter)
        tells.update((g, e) for g, n in shorter.items() if (e := told(n, usual[g])) >= EVIDENCE)
    holders = defaultdict(list)
    for w in here.keys() | there.keys():
        for length in range(GRAMS[0], GRAMS[1] + 1):
            for g in _grams(w, length, tells):
                holders[g].append(w)
    marks, marked = set(), set()
    gain = {g: e * (len(g.encode("utf-8", "surrogatepass")) - MATCH) for g, e in tells.items()}
    for g in sorted((g for g in gain if gain[g] > 0), key=lambda g: (-gain[g], g)):
        rest = [w for w in holders[g] if w not in marked]
        if told(sum(here.get(w, 0) for w in rest), sum(there[w] for w in rest)) >= EVIDENCE \
                and len({i for w in rest for i in texts.get(w, ())}) >= least:
            marks.add(g)
            marked.update(rest)
    return marks


def _marked(word: str, marks: set[str]) -> list[str]:
    """The longest runs of ``word`` that marks cover."""
    covered = bytearray(len(word))
    for length in range(GRAMS[0], GRAMS[1] + 1):
        for i in range(len(word) - length + 1):
            if word[i:i + length] in marks:
                covered[i:i + length] = b"\1" * length
    return [word[m.start():m.end()] for m in re.finditer(b"\1+", covered)]


def toxic_phrases(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Training text of the toxic dictionary: of each toxic text, what
    ``toxic_marks`` cover of its words."""
    marks = toxic_marks(toxic, ordinary) if toxic else set()
    found = {w: _marked(w, marks) for w in set().union(*map(_words, toxic))} if marks else {}
    out = ["".join(r for w in sorted(_words(t)) for r in found.get(w, ())) for t in toxic]
    return [p.encode("utf-8", "surrogatepass") for p in out if p]


def trained(size: int, samples: list[bytes], **options) -> bytes:
    """A zstandard dictionary, or the samples themselves where they are too
    few to train one."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL, **options).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps, with ``BALANCE`` of the weight
    on the toxic class: (centre, scale, weights)."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - centre) / scale]
    share = y.mean()
    weight = np.where(y == 1, BALANCE / share, (1 - BALANCE) / (1 - share)) if 0 < share < 1 else np.ones(len(y))
    w, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], RIDGE)
    ridge[0] = 1e-3
    for _ in range(60):
        p = sigmoid(a @ w)
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(ridge),
                               a.T @ (weight * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, w


def spread_windows(texts: list[str], most: int = ORDINARY_WINDOWS, seed: str = "windows") -> list[bytes]:
    """All windows of ``texts``, or ``most`` of them: then each text gives at
    most an equal share, drawn at random over its whole length."""
    sizes = [len(windows(t)) for t in texts]
    share, left, over = 0, most, sorted(sizes)
    for i, n in enumerate(over):
        share = left // (len(over) - i)
        if n > share:
            break
        share, left = n, left - n
    rng, out = random.Random(seed), []
    extra = most - sum(min(n, share) for n in sizes)
    for n, t in zip(sizes, texts):
        take = min(n, share + (n > share and extra > 0))
        extra -= take > share
        all_of_it = windows(t)
        out += [all_of_it[i] for i in sorted(rng.sample(range(n), take))]
    return out


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    common = trained(ORDINARY_BYTES, spread_windows(ordinary))
    return common, trained(TOXIC_BYTES, toxic_phrases(toxic, ordinary) * 4, k=SEGMENT, d=6) if toxic else b""


def train(docs: DataFrame, labels: DataFrame, seed: str = "toxicity") -> ToxicityModel:
    """Fit on a bounded sample: at most ``SAMPLE`` labelled texts of each
    class (2,000 toxic, 4,000 ordinary)."""
    sample = labelled_sample(docs, labels, "toxic", seed, SAMPLE)
    toxic, ordinary = (_distinct([t for t, y in sample if y == v]) for v in (1, 0))
    x, y = [], []
    for half in (0, 1):
        measure = Distance(*dictionaries(toxic[half::2], ordinary[half::2]))
        for label, texts in ((1.0, toxic), (0.0, ordinary)):
            for t in texts[1 - half::2]:
                x.append(measure.features(t))
                y.append(label)
    if not x:
        x, y = [Distance(b"", b"").features("")], [0.0]
    return ToxicityModel(*dictionaries(toxic, ordinary), *_curve(np.array(x), np.array(y)))


def score_column(docs: DataFrame, model: ToxicityModel) -> Column:
    """The score of each row's whole text.

    Defined cases: a null, empty or blank text has no windows and gets the
    score of a text without savings; repeated rows get equal scores."""
    shared = broadcast_fields(docs.sparkSession, model)

    def setup():
        m = ToxicityModel(*shared.value)
        measure = Distance(m.ordinary, m.toxic)

        def score(texts):
            x = np.array([measure.features(t) for t in texts]).reshape(-1, len(m.centre))
            return sigmoid(m.weights[0] + ((x - m.centre) / m.scale) @ m.weights[1:])
        return score
    return text_score(setup)(F.col("text").cast("string"))


def learnable(labels: DataFrame) -> DataFrame:
    """Label rows that may be learnt from: those outside the held-out third."""
    return labels.filter(~held_out(3, 1))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, learnable(labels))
    return docs.select("doc_id", held_out(3, 1).alias("held_out"), score_column(docs, model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, that are not scored toxic."""
    return docs.filter(score_column(docs, train(docs, learnable(labels))) < THRESHOLD)

"""Small document tables and brute-force versions of the operators."""

import random
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lamda", "mu"]


def prose(rng: random.Random, n: int, vocabulary=None) -> str:
    words = vocabulary or [f"w{i}" for i in range(400)]
    out = [rng.choice(words) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") + ("\n" if i % 40 == 39 else "") for i, w in enumerate(out))


def frame(spark, rows):
    """rows: (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)


def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text."""
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", "b"), (4, "one", None), (5, "one two three four", "b"),
        (5, "one two three four", "b"), (None, "no id here at all, none", "a"), (None, None, None),
        (6, "word " * 30_000, "a"), (7, "Grün éà 漢字 \U0001f600 x", "c"), (8, "ONE two Three FOUR five", "c"),
        (9, "one TWO three four FIVE", "c"),
    ]


def with_clashes(df):
    """Extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    names = ["size", "h", "key", "rep", "value", "n", "score", "shard", "block", "bin", "target", "piece", "part", "p"]
    return df.select("*", *[F.lit(f"x-{c}").alias(c) for c in names])


def words_of(text):
    return [w for w in (text or "").encode().lower().split()]


def shingles(text):
    w = words_of(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def components(rows, percent=75):
    """{doc_id: smallest reachable id} by comparing all pairs."""
    sets = {i: shingles(t) for i, t, *_ in rows if i is not None}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x = len(sets[a] & sets[b])
            if x and 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}

"""URL filters: host word segmentation and naive Bayes, after fixed rules.

A rule is a host and the start of a path; it fits its host and all subdomains,
and the longest one that fits decides.  Every other URL is judged by what it
says: concatenated names are split into words by a unigram Viterbi search, and
multinomial naive Bayes scores the segmented host and path tokens.  It learns
from the pages that the rules decide, plus a short list of seed words.

The unigram counts come from all words of all page texts, with no least count,
greatest length or number of words.  They never meet as one table: the
substrings of each distinct name are joined with the counted words, so a name
comes to its task with just the words that occur in it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import small, stash

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
#: Words up to this length are joined as substrings, longer ones by their first letters.
SHORT_WORD = 24
BUCKETS = 1 << 16
SMOOTH = 0.5
SEED_WEIGHT = 200.0
SEED_COUNT = 300
#: Words that speak for blocking before anything is learnt.
SEED_WORDS = ("spam", "farm", "cheap", "pills", "casino", "viagra", "porn", "xxx", "warez", "loan", "betting")
#: Log odds are whole multiples of this, so that their sums don't depend on order.
STEP = 1e-6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NAME = r"\p{L}+|\p{Nd}+"


def host_of(url: str = "url") -> Column:
    """Between the first :// and the next /, ?, # or the end; A-Z lowered."""
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null.  Needs
    the columns host and path."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


@dataclass(frozen=True)
class Segmenter:
    """Unigram Viterbi: the split of a name into words of the highest product
    of word probabilities.  A run of unknown letters costs more than any known
    word for each of its letters."""
    cost: dict
    letter: float

    def __call__(self, name: str) -> list[str]:
        lengths = sorted({len(w) for w in self.cost})
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            options = [(best[end - 1] + self.letter, end - 1)]
            for n in lengths:
                if n > end:
                    break
                price = self.cost.get(name[end - n:end])
                if price is not None:
                    options.append((best[end - n] + price, end - n))
            price, start = min(options)
            best.append(price)
            back.append(start)
        out, end = [], len(name)
        while end:
            out.append(name[back[end]:end])
            end = back[end]
        return out[::-1]


def unigrams(pages: DataFrame, seeds: Sequence[str] = SEED_WORDS) -> DataFrame:
    """(word, n): every word of two letters or more over the text of *all*
    pages, mark-up removed; a seed word counts ``SEED_COUNT`` at least."""
    text = F.regexp_replace(F.coalesce(F.col("html").cast("string"), F.lit("")), r"(?s)<[^>]*>", " ")
    words = pages.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")) \
        .filter("length(word) > 1").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    listed = pages.sparkSession.createDataFrame([(w, SEED_COUNT) for w in seeds], "word string, n long")
    return words.union(listed).groupBy("word").agg(F.max("n").alias("n"))


def spoken(urls: DataFrame) -> DataFrame:
    """(url_key, kind, key, name, n): the names in the host (h) and the path
    (p) of each distinct URL and how often it holds them; ``key`` is short
    however long a name is."""
    def names(part: str, kind: str) -> Column:
        found = F.regexp_extract_all(F.lower(part), F.lit(_NAME), F.lit(0))
        return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("name")))
    said = urls.select("url_key", F.explode(F.concat(names("host", "h"), names("path", "p"))).alias("t"))
    return said.groupBy("url_key", "t.kind", "t.name").agg(F.count(F.lit(1)).alias("n")) \
        .select("url_key", "kind", F.md5("name").alias("key"), "name", "n")


def segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """(key, words): each distinct name of ``names`` (key, name) split into the
    words of ``words`` (word, n) of the highest product of probabilities."""
    total = float(words.agg(F.sum("n")).first()[0] or 1)
    size = F.length("name")
    letters = names.filter(F.col("name").rlike(r"^\p{L}"))
    starts = letters.filter(size > 1).withColumn("start", F.explode(F.sequence(F.lit(1), size - 1)))
    sizes = F.sequence(F.lit(2), F.least(F.lit(SHORT_WORD), size - F.col("start") + 1))
    pieces = starts.select("key", F.explode(F.transform(
        sizes, lambda n: F.substring(F.col("name"), F.col("start"), n))).alias("word")).distinct()
    inside = pieces.join(words, "word").select("key", "word", "n")
    # a longer word is found by its first letters and then compared whole
    longer = words.filter(F.length("word") > SHORT_WORD).withColumn("head", F.substring("word", 1, SHORT_WORD))
    heads = pieces.filter(F.length("word") == SHORT_WORD).withColumnRenamed("word", "head")
    inside = inside.union(heads.join(longer, "head").join(letters, "key")
                          .filter(F.col("name").contains(F.col("word"))).select("key", "word", "n"))
    priced = inside.groupBy("key").agg(F.collect_list(F.struct("word", (F.log(F.lit(total)) - F.log("n")).alias("cost")))
                                       .alias("w"))
    letter = float(np.log(total) + 1.0)

    @F.pandas_udf("array<string>")
    def split(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for names, known, costs in parts:
            yield pd.Series([Segmenter(dict(zip(w, c)) if w is not None else {}, letter)(name)
                             for name, w, c in zip(names, known, costs)])

    return names.join(priced, "key", "left").select("key", split("name", "w.word", "w.cost").alias("words"))


def bucket(kind: str, word: str) -> Column:
    return F.pmod(F.xxhash64(F.concat_ws(":", kind, word)), F.lit(BUCKETS)).cast("int")


def learnt(said: DataFrame, judged: DataFrame, words_of: DataFrame,
           seeds: Sequence[str] = SEED_WORDS) -> tuple[np.ndarray, float]:
    """(log odds of 'block' per token bucket, the prior's), counted over all
    pages of ``judged`` (url_key, verdict).  Counts are summed by Spark: names
    by verdict before they are split, then two rows for each bucket at most."""
    pages = judged.groupBy("url_key", "verdict").agg(F.count(F.lit(1)).alias("pages"))
    names = said.join(pages, "url_key").groupBy("verdict", "kind", "key").agg(F.sum(F.col("n") * F.col("pages")).alias("n"))
    tokens = names.join(words_of, "key").select("verdict", "kind", "n", F.explode("words").alias("word"))
    counts = np.full((2, BUCKETS), 0.0)
    for r in tokens.groupBy("verdict", bucket("kind", "word").alias("b")).agg(F.sum("n").alias("n")).collect():
        counts[int(r["verdict"] == "block"), r["b"]] += r["n"]
    listed = judged.sparkSession.createDataFrame([(k, w) for k in "hp" for w in seeds], "kind string, word string")
    for r in listed.select(bucket("kind", "word").alias("b")).collect():
        counts[1, r["b"]] += SEED_WEIGHT
    counts += SMOOTH
    logs = np.log(counts / counts.sum(1, keepdims=True))
    seen = {r["verdict"]: r["n"] for r in pages.groupBy("verdict").agg(F.sum("pages").alias("n")).collect()}
    return logs[1] - logs[0], float(np.log((seen.get("block", 0) + 1) / (seen.get("allow", 0) + 1)))


def judged_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
                seeds: Sequence[str] = SEED_WORDS, fit: Column | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score (odds of 'block' by the
    method, for every URL).  ``fit`` picks the pages, among those that a rule
    decides, to learn from: all of them unless given.

    Defined cases: a null URL or one without :// has an empty host and path,
    no rule, and the verdict of the prior; a null html adds no words; repeated
    rows get equal verdicts; a score of exactly 1/2 blocks.
    """
    spark = pages.sparkSession
    parts = pages.select("page_id", host_of().alias("host"), path_of().alias("path"),
                         F.coalesce(F.lit(True) if fit is None else fit, F.lit(False)).alias("fit"))
    parts = parts.withColumn("url_key", F.md5(F.concat("host", F.lit("\n"), "path"))).withColumn("r", rule_of(rules))
    parts = stash(parts.select("page_id", "host", "path", "url_key", "fit", "r.rule", "r.verdict"), "urls")
    said = stash(spoken(parts.dropDuplicates(["url_key"])), "url-names")
    words = stash(unigrams(pages, seeds), "words")
    words_of = stash(segmented(said.select("key", "name").distinct(), words), "segmented")
    odds, prior = learnt(said, parts.filter("rule IS NOT NULL AND fit").select("url_key", "verdict"), words_of, seeds)
    steps = pd.DataFrame({"bucket": np.arange(BUCKETS, dtype=np.int32), "odds": np.rint(odds / STEP).astype(np.int64)})
    steps = F.broadcast(spark.createDataFrame(steps, "bucket int, odds long"))  # BUCKETS rows
    tokens = words_of.select("key", F.explode(F.array(F.lit("h"), F.lit("p"))).alias("kind"), "words") \
        .select("key", "kind", F.explode("words").alias("word"))
    of_name = tokens.join(steps, bucket("kind", "word") == F.col("bucket")).groupBy("key", "kind") \
        .agg(F.sum("odds").alias("odds"))
    of_name = small(stash(of_name, "name-odds"))
    of_url = said.join(of_name, ["key", "kind"]).groupBy("url_key").agg(F.sum(F.col("n") * F.col("odds")).alias("odds"))
    z = F.coalesce("odds", F.lit(0)) + F.lit(int(np.rint(prior / STEP)))
    logit = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z * F.lit(STEP)))
    return parts.join(of_url, "url_key", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(z >= 0, "block").otherwise("allow")).alias("verdict"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))).alias("score"))

import itertools
import math
import random
import re
from collections import Counter

import pytest
from corpus_helpers import with_clashes
from pyspark.sql import functions as F

from threadlens.llm import url_filter
from threadlens.llm.queries import op9_url_filter

RULES = {"net/": ("block", "net", "/"), "example.net/en/": ("allow", "example.net", "/en/"),
         "example.com/de/": ("block", "example.com", "/de/"), "org/fr/": ("allow", "org", "/fr/")}


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def rule(host, path):
    fits = [r for r, (_, h, p) in RULES.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=len, default=None)


def test_rules_against_brute_force(spark):
    urls = ["http://a.example.net/en/x", "https://NET/", "http://xnet/en/", "http://example.com/de/1?q=/x#y",
            "http://b.org/fr/", "http://b.org/de/", "ftp://u:p@A.Example.ORG/fr/?a://b", None, "", "no scheme",
            "http://", "://h.net", "http://example.net", "http://a\nb.net/x\ny", "http://example.net/EN/",
            "http://notexample.com/de/", "x://y.example.com/de/#/", "http://Éa.net/é"]
    pages = spark.createDataFrame([(i, u, None if i % 2 else "<p>some words</p>") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string")
    out = {r.page_id: r for r in url_filter.judged_urls(with_clashes(pages)).collect()}
    assert len(out) == len(urls)
    for i, u in enumerate(urls):
        host, path = parts(u)
        want = rule(host, path)
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, want), u
        assert out[i].verdict == RULES[want][0] if want else out[i].verdict in ("allow", "block")
    assert url_filter.judged_urls(pages.filter("false")).collect() == []


def test_viterbi_finds_the_best_split():
    words = {"cheap": 4.0, "pills": 5.0, "pill": 5.5, "s": 6.0, "chea": 7.0, "p": 6.5, "ppills": 20.0}
    segment = url_filter.Segmenter(words, 12.0)

    def cost(split):
        return sum(words.get(w, 12.0 if len(w) == 1 else math.inf) for w in split)
    for name in ("cheappills", "pillspill", "xcheap", "", "zz"):
        cuts = [[name[a:b] for a, b in itertools.pairwise((0, *c, len(name)))]
                for n in range(max(1, len(name))) for c in itertools.combinations(range(1, len(name)), n)]
        best = min((cost(c) for c in cuts if name), default=0)
        got = segment(name)
        assert "".join(got) == name
        assert cost(got) == pytest.approx(best)
    assert segment("cheappills") == ["cheap", "pills"]


def test_spam_hosts_are_blocked(spark):
    rows = op9_url_filter(spark, "/root/testdata/sf0.01").collect()
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()
    assert len(rows) == len(pages)
    spam = [r for r in rows if r.rule is None and ("spam-farm" in r.host or "cheap-pills" in r.host)]
    assert spam and all(r.verdict == "block" for r in spam)
    assert any(r.verdict == "allow" and r.rule is None for r in rows)


def brute_scores(pages, seeds):
    """Scores by one dictionary of all words and plain counts of tokens."""
    counts = Counter(w for _, _, html in pages
                     for w in re.findall(r"[^\W\d_]{2,}", re.sub(r"(?s)<[^>]*>", " ", html or "").lower()))
    for w in seeds:
        counts[w] = max(counts[w], url_filter.SEED_COUNT)
    total = sum(counts.values())
    segment = url_filter.Segmenter({w: math.log(total / n) for w, n in counts.items()}, math.log(total) + 1)

    def tokens(url):
        return [kind + w for kind, part in zip("hp", parts(url))
                for name in re.findall(r"[^\W\d_]+|\d+", part.lower()) for w in segment(name)]
    seen = {"block": Counter(), "allow": Counter()}
    prior = Counter()
    for _, url, _ in pages:
        fits = rule(*parts(url))
        if fits:
            seen[RULES[fits][0]].update(tokens(url))
            prior[RULES[fits][0]] += 1
    seen["block"].update({k + w: url_filter.SEED_WEIGHT for k in "hp" for w in seeds})

    def odds(verdict, token):
        return math.log((seen[verdict][token] + url_filter.SMOOTH)
                        / (sum(seen[verdict].values()) + url_filter.SMOOTH * url_filter.BUCKETS))
    start = math.log((prior["block"] + 1) / (prior["allow"] + 1))
    z = {i: start + sum(odds("block", t) - odds("allow", t) for t in tokens(url)) for i, url, _ in pages}
    return {i: 1 / (1 + math.exp(-max(-30, min(30, v)))) for i, v in z.items()}


LONG = "pneumonoultramicroscopicsilicovolcanoconiosis"


def odd_pages():
    words = ["cheap", "pills", "river", "stone", "garden", "news", "daily", "the", "of", LONG]
    rng = random.Random(4)
    urls = [f"http://{rng.choice(words)}{rng.choice(words)}.example.{rng.choice(['net', 'org', 'com'])}"
            f"/{rng.choice(['fr', 'en', 'de'])}/{rng.choice(words)}{rng.choice(words)}-{n}" for n in range(60)]
    urls += [None, "", "http://", f"http://{LONG}x{LONG}.biz/{'stonegarden' * 400}", f"http://{'x' * 3000}.org/fr/{'z' * 5000}"]
    urls += [urls[3]] * 40  # repeated rows
    return [(i, u, None if i % 7 == 3 else f"<p>{' '.join(rng.choices(words, k=8))}</p> {'stone ' * (3000 if i == 5 else 0)}")
            for i, u in enumerate(urls)]


@pytest.mark.parametrize("seeds", [(), url_filter.SEED_WORDS])
def test_scores_against_brute_force(spark, seeds):
    pages = odd_pages()
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judged_urls(df, seeds=seeds).collect()}
    want = brute_scores(pages, seeds)
    assert set(got) == set(want)
    for i, score in want.items():
        assert got[i].score == pytest.approx(score, abs=1e-4)
        if got[i].rule is None and abs(score - 0.5) > 1e-4:
            assert got[i].verdict == ("block" if score >= 0.5 else "allow")


def test_rare_and_long_words_split_names(spark):
    words = spark.createDataFrame([("rare", 1), (LONG, 1), ("common", 100_000)], "word string, n long")
    names = spark.createDataFrame([("a", f"rare{LONG}common"), ("b", LONG[:30]), ("c", "123"), ("d", "q")],
                                  "key string, name string")
    out = {r.key: r.words for r in url_filter.segmented(names, words).collect()}
    assert out["a"] == ["rare", LONG, "common"]
    assert out["b"] == list(LONG[:30]) and out["c"] == ["1", "2", "3"] and out["d"] == ["q"]


def test_held_out_pages_without_seed_words(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    held = F.crc32(F.col("page_id").cast("string")) % 4 == 2
    out = url_filter.judged_urls(pages, seeds=(), fit=~held).join(pages.filter(held).select("page_id"), "page_id")
    rows = out.filter("rule IS NOT NULL").collect()
    right = sum((r.score >= 0.5) == (r.verdict == "block") for r in rows) / len(rows)
    common = sum(r.verdict == "block" for r in rows) / len(rows)
    print(f"held out {len(rows)}, right {right:.3f}, blocked {common:.3f}")
    # tokens one by one can't say "net but not /en/", so some stay wrong
    assert right > max(common, 1 - common) + 0.1

"""Property tests: operators against brute force in plain Python on random
small inputs."""

import hashlib
from collections import Counter, defaultdict
from datetime import datetime, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import comment, comments_df
from threadlens.functions import ids, timefmt
from threadlens.operators import graph, history, recommend

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@SETTINGS
@given(st.lists(st.integers(min_value=-2_000_000_000, max_value=4_000_000_000), min_size=1, max_size=60))
def test_time_helpers_match_datetime(spark, epochs):
    df = spark.createDataFrame([(e,) for e in epochs], "e long")
    got = df.select("e", timefmt.utc_year("e").alias("y"), timefmt.utc_month("e").alias("m"),
                    timefmt.minute_slot("e").alias("slot"), timefmt.format_mdy_hms("e").alias("f")).collect()
    for r in got:
        d = datetime.fromtimestamp(r.e, tz=timezone.utc)
        assert (r.y, r.m) == (d.year, d.month)
        assert r.slot == int(d.strftime("%Y%m%d%H%M"))
        assert r.f == d.strftime("%m-%d-%Y %H:%M:%S")


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=2 ** 62), min_size=1, max_size=60),
       st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=30))
def test_ids_match_python(spark, numbers, names):
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    for r in df.select("n", ids.long_to_base36("n").alias("s")).select(
            "n", "s", ids.base36_to_long("s").alias("back")).collect():
        assert int(r.s, 36) == r.n == r.back
    nd = spark.createDataFrame([(x,) for x in names], "x string")
    for r in nd.select("x", ids.stable_hash("x").alias("h")).collect():
        assert r.h == int(hashlib.md5(r.x.encode()).hexdigest()[:8], 16) % 10 ** 8


author_st = st.sampled_from(["a", "b", "c", "d", "e", "[deleted]", None])
sub_st = st.sampled_from(["s1", "s2", "s3", "s4", "s5", "s6", "s7", "s8", "s9"])


@st.composite
def threads(draw):
    n = draw(st.integers(min_value=2, max_value=40))
    rows = []
    for i in range(n):
        parent = draw(st.one_of(st.none(), st.integers(min_value=0, max_value=max(0, i - 1))))
        rows.append(comment(f"x{i}", draw(author_st), subreddit=draw(sub_st),
                            created_utc=1_700_000_000 + draw(st.integers(0, 5)),
                            parent_id=f"t1_x{parent}" if parent is not None and parent < i else "t3_t"))
    return rows


def _brute_edges(rows):
    by_id = {r["id"]: r for r in rows}
    out = []
    for r in rows:
        p = by_id.get(r["parent_id"][3:]) if r["parent_id"].startswith("t1_") else None
        if p and p["author"] not in (None, "[deleted]") and r["author"] not in (None, "[deleted]"):
            out.append((p["subreddit"], p["author"], r["author"]))
    return out


def _leader(counts):
    """Top author per subreddit: highest count, then smaller name."""
    best = {}
    for (sub, a), n in counts.items():
        if sub not in best or (-n, a) < (-best[sub][1], best[sub][0]):
            best[sub] = (a, n)
    return best


@SETTINGS
@given(threads())
def test_engagement_and_recommend_match_brute_force(spark, rows):
    c = comments_df(spark, rows)
    edges = _brute_edges(rows)
    indeg = Counter((s, o) for s, o, _ in edges)
    outdeg = Counter((s, r) for s, _, r in edges)
    top_in, top_out = _leader(indeg), _leader(outdeg)
    got = {r.subreddit: (r.influential_user, r.influence, r.active_user, r.activity)
           for r in graph.engagement(graph.reply_edges(c)).collect()}
    assert got == {s: (top_in[s][0], top_in[s][1], top_out[s][0], top_out[s][1]) for s in top_in}

    block = {"s7"}
    posts = defaultdict(set)
    for r in rows:
        if r["author"] not in (None, "[deleted]"):
            posts[r["author"]].add(r["subreddit"])
    want = set()
    for seed, (lead, _) in top_out.items():
        cands = sorted((hashlib.md5(f"{lead}|{s}".encode()).hexdigest(), s)
                       for s in posts[lead] if s != seed and s not in block)
        want |= {(seed, lead, s, i + 1) for i, (_, s) in enumerate(cands[:6])}
    bl = spark.createDataFrame([(b,) for b in block], "name string")
    got_rec = {tuple(r) for r in recommend.graph_recommend(c, graph.reply_edges(c), bl, k=6).collect()}
    assert got_rec == want


@SETTINGS
@given(threads())
def test_first_posts_match_brute_force(spark, rows):
    c = comments_df(spark, rows).withColumn("body", F.col("id"))   # body identifies the row
    want = {}
    for r in rows:
        key = (r["created_utc"], int(r["id"], 36))
        if r["author"] not in want or key < want[r["author"]][0]:
            want[r["author"]] = (key, r["id"])
    got = {r.author: r.body for r in history.first_posts(c).collect()}
    assert got == {a: v[1] for a, v in want.items()}

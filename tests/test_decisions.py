"""Hand-made rows for each behaviour decision (FIXTURES.md F12)."""

from pyspark.sql import functions as F

from helpers import comment, comments_df
from threadlens.operators import graph, history, live, recommend, snapshot
from threadlens.sources import json_source


def test_deleted_and_null_authors_leave_graph_and_counts(spark):
    rows = [comment("a", "alice"), comment("b", "[deleted]", parent_id="t1_a"),
            comment("c", None, parent_id="t1_a"), comment("d", "bob", parent_id="t1_a"),
            comment("e", "carol", parent_id="t1_b")]
    c = comments_df(spark, rows)
    edges = graph.reply_edges(c).collect()
    assert [(e.OrigAuth, e.RespAuth) for e in edges] == [("alice", "bob")]
    counts = {r.author for r in recommend.interaction_counts(c).collect()}
    assert counts == {"alice", "bob", "carol"}
    # snapshot keeps '[deleted]' as one author and counts NULL in the total only
    stats = snapshot.monthly_stats(c).collect()[0]
    assert stats.total_comments == 5 and stats.distinct_authors == 4


def test_rank_tie_keeps_both_and_top_is_smaller_name(spark):
    rows = [comment("p", "zed"), comment("q", "amy"),
            comment("r1", "x", parent_id="t1_p"), comment("r2", "y", parent_id="t1_q")]
    edges = graph.reply_edges(comments_df(spark, rows))
    indeg = {(r.author, r.rank) for r in graph.degrees(edges, "indegree").collect()}
    assert indeg == {("zed", 1), ("amy", 1)}
    top = graph.leaders(edges, "indegree").collect()
    assert [(t.author, t.rank) for t in top] == [("amy", 1)]


def test_equal_first_timestamps_smaller_code_first(spark):
    # 'z' is code 35 and '10' is code 36: string order would pick '10'
    rows = [comment("10", "ann", body="second"), comment("z", "ann", body="first")]
    first = history.first_posts(comments_df(spark, rows)).collect()
    assert [r.body for r in first] == ["first"]


def test_bad_created_utc_becomes_null(spark, tmp_path):
    p = tmp_path / "raw.json"
    p.write_text('{"id":"a","author":"u","created_utc":"zz"}\n{"id":"b","author":"v","created_utc":"17"}\n'
                 'not json\n')
    raw = json_source.read_raw_comments(spark, str(p)).persist()
    typed = {r.id: r.created_utc for r in json_source.typed_comments(raw).collect()}
    assert typed == {"a": None, "b": 17}
    assert json_source.dead_letters(raw).count() == 1


def test_only_null_authors_ratio_is_null(spark):
    rows = [comment("a", None), comment("b", None)]
    stats = snapshot.monthly_stats(comments_df(spark, rows)).collect()[0]
    assert stats.total_comments == 2 and stats.distinct_authors == 0
    assert stats.comments_per_distinct_author is None
    assert stats.comments_per_distinct_submission == 2.0


def test_malformed_and_missing_key_messages(spark):
    msgs = spark.createDataFrame(
        [(1, 100, '{"author":"a","subreddit":"s","created_utc":60}'),
         (2, 101, "not json"),
         (3, 102, '{"subreddit":"s","created_utc":61}')],
        "offset long, arrived_at long, value string")
    parsed = live.parse_messages(msgs)
    dead = live.dead_letters(parsed, keep=("offset",)).collect()
    assert [(d.offset, d.message) for d in dead] == [(2, "not json")]
    good = live.good_records(parsed)
    assert good.count() == 2
    trends = live.minute_trends(good, "subreddit", "created_utc").collect()
    assert [(t.subreddit, t["count"]) for t in trends] == [("s", 1)]


def _leader_rows(leader_subs, seed="seed"):
    """``leader`` replies most in ``seed`` and also posts in ``leader_subs``."""
    rows = [comment("p", "op", subreddit=seed)]
    rows += [comment(f"r{i}", "lead", subreddit=seed, parent_id="t1_p") for i in range(3)]
    rows += [comment(f"x{i}", "lead", subreddit=s) for i, s in enumerate(leader_subs)]
    return rows


def test_few_candidates_give_fewer_rows(spark):
    c = comments_df(spark, _leader_rows(["s1", "s2", "s3"]))
    recs = recommend.graph_recommend(c, graph.reply_edges(c)).collect()
    assert sorted(r.subreddit for r in recs) == ["s1", "s2", "s3"]
    assert sorted(r.position for r in recs) == [1, 2, 3]


def test_block_listed_neighbours_both_removed(spark):
    c = comments_df(spark, _leader_rows(["s1", "bad1", "bad2", "s2"]))
    block = spark.createDataFrame([("bad1",), ("bad2",)], "name string")
    recs = recommend.graph_recommend(c, graph.reply_edges(c), block).collect()
    assert sorted(r.subreddit for r in recs) == ["s1", "s2"]


def test_recommendation_capped_at_six_and_excludes_seed(spark):
    subs = [f"s{i}" for i in range(12)]
    c = comments_df(spark, _leader_rows(subs))
    recs = recommend.graph_recommend(c, graph.reply_edges(c)).collect()
    assert len(recs) == 6 and "seed" not in {r.subreddit for r in recs}
    assert sorted(r.position for r in recs) == list(range(1, 7))


def test_unknown_and_empty_user(spark):
    c = comments_df(spark, [comment("a", "alice")])
    assert history.author_posts(c, "").count() == 0
    assert history.author_posts(c, "nobody").count() == 0
    assert history.author_count(c, "").collect()[0].n_comments == 0


def test_parent_in_another_month(spark):
    rows = [comment("a", "alice", created_utc=1706745599),          # 2024-01-31 23:59:59
            comment("b", "bob", created_utc=1706745601, parent_id="t1_a")]  # 2024-02-01
    edges = graph.reply_edges(comments_df(spark, rows)).collect()
    assert len(edges) == 1


def test_self_reply_counts_in_both_degrees(spark):
    rows = [comment("a", "alice"), comment("b", "alice", parent_id="t1_a")]
    edges = graph.reply_edges(comments_df(spark, rows))
    assert graph.degrees(edges, "indegree").collect()[0].rank == 1
    assert graph.degrees(edges, "outdegree").collect()[0].rank == 1


def test_top_20_per_minute(spark):
    rows = []
    for a in range(25):
        for j in range(25 - a):
            rows.append({"author": f"a{a:02d}", "subreddit": "s", "created_utc": 120 + j % 60})
    recs = spark.createDataFrame(rows, "author string, subreddit string, created_utc long")
    top = live.minute_trends(recs, "author", "created_utc").orderBy("rank").collect()
    assert len(top) == 20
    assert [t["count"] for t in top] == list(range(25, 5, -1))
    assert [t.rank for t in top] == list(range(1, 21))


def test_zone_free_time_fields(spark):
    df = spark.createDataFrame([(1706745599,)], "e long")
    from threadlens.functions import timefmt as T
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = df.select(T.utc_year("e").alias("y"), T.utc_month("e").alias("m"),
                      T.minute_slot("e").alias("slot"), T.format_mdy_hms("e").alias("f")).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.y, r.m, r.slot, r.f) == (2024, 1, 202401312359, "01-31-2024 23:59:59")


def test_hash_audit_finds_collisions_with_small_modulus(spark):
    names = spark.createDataFrame([(f"user{i}",) for i in range(200)], "author string")
    audit = recommend.hash_audit(names, "author", modulus=50).collect()
    assert audit and all(a.names > 1 for a in audit)
    assert sum(a.names for a in audit) <= 200


def test_upsert_last_write_wins(spark):
    from threadlens.operators.sink import upsert_latest
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, "only")],
                               "key string, version int, v string")
    out = {r.key: r.v for r in upsert_latest(df, ["key"], [F.col("version")]).collect()}
    assert out == {"k": "new", "j": "only"}


def test_fixture_epochs_do_not_depend_on_session_zone(spark):
    from conftest import SF001
    from threadlens.sources import fixtures
    cols = ["id", "created_utc", "retrieved_on"]
    utc = sorted(fixtures.load_comments(spark, SF001).select(*cols).collect())
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        other = sorted(fixtures.load_comments(spark, SF001).select(*cols).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other


def test_approximate_distinct_counts_close_to_exact(spark):
    from conftest import SF01
    from threadlens.sources import fixtures
    c = fixtures.load_comments(spark, SF01)
    exact = {(r.year, r.month, r.subreddit): r.distinct_authors for r in snapshot.monthly_stats(c).collect()}
    approx = {(r.year, r.month, r.subreddit): r.distinct_authors
              for r in snapshot.monthly_stats(c, exact=False).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= max(2, 0.1 * v) for k, v in exact.items())

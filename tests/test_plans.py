"""Physical plans: pushdown, pruning, partial top-k, no Python in any plan."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF001
from threadlens.operators import graph, history, snapshot
from threadlens.plans.inspect import explain_string, pushed_filters, python_nodes, read_schemas
from threadlens.sources import fixtures

BATCH = ["q_snapshot", "q_edges", "q_engagement", "q_first_post", "q_recommend", "q_user_counts",
         "q_history", "q_degree_export", "q_upsert", "q_to_json", "q_dead_letter", "q_post_titles"]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_evaluation(spark, name):
    assert python_nodes(entry_mod.queries()[name](spark, SF001)) == []


@pytest.mark.parametrize("layout", ["local", "range"])
def test_keyed_read_pushes_author_filter(spark, tmp_path, layout):
    from threadlens.sources import json_source
    out = str(tmp_path / "c")
    json_source.write_comments_parquet(fixtures.load_comments(spark, SF001), out, layout=layout)
    assert history.author_posts(json_source.read_comments_parquet(spark, out), "u8").count() == \
        history.author_posts(fixtures.load_comments(spark, SF001), "u8").count()
    df = history.author_posts(json_source.read_comments_parquet(spark, out), "u8")
    assert any("EqualTo(author,u8)" in f for f in pushed_filters(df))
    # five projected columns (plus partition columns), not all twenty
    schema = read_schemas(df)[0]
    assert "retrieved_on" not in schema and "body" in schema


def test_reply_side_prefix_filter_is_pushed(spark, tmp_path):
    from threadlens.sources import json_source
    out = str(tmp_path / "c")
    json_source.write_comments_parquet(fixtures.load_comments(spark, SF001), out)
    df = graph.reply_edges(json_source.read_comments_parquet(spark, out))
    filters = " ".join(pushed_filters(df))
    assert "StringStartsWith(parent_id,t1_)" in filters
    assert "Not(EqualTo(author,[deleted]))" in filters


def test_top_k_is_partial_before_shuffle(spark):
    c = fixtures.load_comments(spark, SF001)
    for df in (history.first_posts(c), graph.leaders(graph.reply_edges(c)),
               snapshot.top_subreddits_per_month(snapshot.monthly_stats(c), 20)):
        plan = explain_string(df)
        assert "WindowGroupLimit" in plan


def test_snapshot_scan_is_pruned(spark):
    df = entry_mod.queries()["q_snapshot"](spark, SF001)
    schema = read_schemas(df)[0]
    assert "event_type" not in schema and "value" not in schema


def test_distinct_counts_use_expand(spark):
    df = snapshot.monthly_stats(fixtures.load_comments(spark, SF001))
    assert "Expand" in explain_string(df)


def test_slot_reads_open_one_day(spark):
    """Stored trends and feed: the day is a partition filter, the slot is pushed."""
    from threadlens.plans import queries as Q
    for name in ("q_trend_read", "q_hour_trend_read", "q_live"):
        plan = explain_string(Q.QUERIES[name](spark, SF001))
        line = next(ln for ln in plan.splitlines() if "PartitionFilters" in ln)
        assert "day" in line.split("PartitionFilters")[1]
        assert any("EqualTo(minuteslot" in f or "EqualTo(secslot" in f
                   for f in pushed_filters(Q.QUERIES[name](spark, SF001)))


def test_recommender_narrows_authors_before_distinct(spark):
    from threadlens.operators import recommend
    c = fixtures.load_comments(spark, SF001)
    plan = explain_string(recommend.graph_recommend(c, graph.reply_edges(c)))
    assert "LeftSemi" in plan


def test_high_water_filter_sits_below_the_dedup(spark):
    from threadlens.plans import queries as Q
    plan = explain_string(Q.q_new_comments(spark, SF001)).splitlines()
    depth = {k: next(i for i, ln in enumerate(plan) if k in ln) for k in ("Filter", "Aggregate")}
    assert depth["Filter"] > depth["Aggregate"]  # printed from the root down

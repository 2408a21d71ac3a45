"""Fixture mapping facts and graph invariants."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from threadlens.operators import graph
from threadlens.sources import fixtures

# (rows, authors incl. [deleted], [deleted] rows, subreddits, threads, edges, self-replies,
#  in-degree rows, distinct (subreddit, rank))
EXPECTED = {
    SF001: (1000, 15, 60, 31, 40, 554, 34, 134, 102),
    SF01: (10000, 146, 310, 116, 400, 5967, 37, 1487, 517),
}


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_fixture_mapping_counts(spark, sf):
    c = fixtures.load_comments(spark, sf)
    edges = graph.reply_edges(c)
    indeg = graph.degrees(edges, "indegree")
    got = (c.count(), c.select("author").distinct().count(),
           c.filter(F.col("author") == "[deleted]").count(),
           c.select("subreddit").distinct().count(), c.select("link_id").distinct().count(),
           edges.count(), edges.filter(F.col("OrigAuth") == F.col("RespAuth")).count(),
           indeg.count(), indeg.select("subreddit", "rank").distinct().count())
    assert got == EXPECTED[sf]


def test_degree_sums_equal_edge_count(spark):
    edges = graph.reply_edges(fixtures.load_comments(spark, SF01)).persist()
    n = edges.count()
    s_in = graph.degrees(edges, "indegree").agg(F.sum("rank")).first()[0]
    s_out = graph.degrees(edges, "outdegree").agg(F.sum("rank")).first()[0]
    edges.unpersist()
    assert s_in == s_out == n


def test_no_reply_crosses_subreddits_in_fixture(spark):
    c = fixtures.load_comments(spark, SF001)
    p = c.select(F.concat(F.lit("t1_"), "id").alias("k"), F.col("subreddit").alias("ps"))
    r = c.select(F.col("parent_id").alias("k"), F.col("subreddit").alias("rs"))
    assert p.join(r, "k").filter(F.col("ps") != F.col("rs")).count() == 0


def test_months_of_fixture(spark):
    from threadlens.functions.timefmt import utc_month, utc_year
    c = fixtures.load_comments(spark, SF001)
    months = {(r[0], r[1]) for r in c.select(utc_year("created_utc"), utc_month("created_utc"))
              .distinct().collect()}
    assert months == {(2024, 1), (2024, 7), (2025, 1)}

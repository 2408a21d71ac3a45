"""Hot keys: one parent comment receives a third of all replies, one author
writes a third of all comments."""

import pytest
from pyspark.sql import functions as F

from helpers import SCHEMA
from threadlens.operators import graph, history
from threadlens.plans.inspect import explain_string

N = 30000

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed(spark):
    """Comment i answers comment 'hot' for a third of i, else comment i-1;
    author 'whale' writes every third comment."""
    ids = spark.range(1, N + 1).withColumnRenamed("id", "i")
    parent = (F.when(F.col("i") % 3 == 0, F.lit("t1_hot"))
              .otherwise(F.concat(F.lit("t1_c"), (F.col("i") - 1).cast("string"))))
    author = F.when(F.col("i") % 3 == 1, F.lit("whale")).otherwise(F.concat(F.lit("a"), (F.col("i") % 97).cast("string")))
    rows = ids.select(
        F.lit(False).alias("archived"), author.alias("author"), F.lit(None).cast("string").alias("author_flair_css_class"),
        F.lit("b").alias("body"), F.lit(0).cast("bigint").alias("controversiality"),
        F.lit(None).cast("string").alias("distinguished"), F.lit(0).cast("bigint").alias("downs"),
        F.lit("false").alias("edited"), F.lit(0).cast("bigint").alias("gilded"),
        F.concat(F.lit("c"), F.col("i").cast("string")).alias("id"), F.lit("t3_x").alias("link_id"),
        F.concat(F.lit("t1_c"), F.col("i").cast("string")).alias("name"), parent.alias("parent_id"),
        F.lit(0).cast("bigint").alias("retrieved_on"), F.lit(1).cast("bigint").alias("score"),
        F.lit(False).alias("score_hidden"), F.lit("s").alias("subreddit"), F.lit(None).cast("string").alias("subreddit_id"),
        F.lit(1).cast("bigint").alias("ups"), (F.lit(1704067200) + F.col("i")).alias("created_utc"))
    hot = spark.createDataFrame([(False, "op", None, "b", 0, None, 0, "false", 0, "hot", "t3_x", "t1_hot", "t3_x",
                                  0, 1, False, "s", None, 1, 1704067200)], SCHEMA)
    return rows.unionByName(hot).repartition(8)


def test_hot_parent_is_split_by_aqe_and_exact(spark, skew_conf):
    c = _skewed(spark)
    edges = graph.reply_edges(c)
    rows = edges.collect()          # runs (and finalizes) the adaptive plan of `edges`
    assert sum(r.OrigId == "hot" for r in rows) == N // 3
    assert len(rows) == N - 1   # every comment but c1 (its parent c0 is absent) has a parent
    final = explain_string(edges, "formatted")
    assert "isFinalPlan=true" in final and "skew=true" in final


def test_whale_author_first_post_and_counts(spark):
    c = _skewed(spark)
    first = {r.author: r.created_utc for r in history.first_posts(c).collect()}
    assert first["whale"] == 1704067201
    plan = explain_string(history.first_posts(c))
    assert "WindowGroupLimit" in plan

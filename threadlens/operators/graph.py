"""Interaction graph: reply edges, in/out-degree, leaders per subreddit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.ids import COMMENT_PREFIX, fullname
from threadlens.operators.common import top_per_group
from threadlens.sources.fixtures import DELETED_AUTHOR

# The column names of the edge table, as its readers know them.
EDGE_COLUMNS = ["Subreddit", "OrigId", "RespId", "OrigAuth", "RespAuth", "OrigScore", "RespScore",
                "OrigUps", "RespUps", "OrigDowns", "RespDowns", "OrigControv", "RespControv"]

# in-degree counts replies received (influence), out-degree replies made (activity)
DEGREE_SIDES = {"indegree": "OrigAuth", "outdegree": "RespAuth"}


def _live_author(df: DataFrame) -> DataFrame:
    # '!=' also drops NULL authors
    return df.filter(F.col("author") != F.lit(DELETED_AUTHOR))


def _edge_sides(comments: DataFrame, month: str | None = None) -> tuple[DataFrame, DataFrame]:
    live = _live_author(comments)
    parents = live.select(
        fullname(COMMENT_PREFIX, "id").alias("_key"),
        F.col("subreddit").alias("Subreddit"), F.col("id").alias("OrigId"),
        F.col("author").alias("OrigAuth"), F.col("score").alias("OrigScore"),
        F.col("ups").alias("OrigUps"), F.col("downs").alias("OrigDowns"),
        F.col("controversiality").alias("OrigControv"),
        *([F.col(month).alias("orig_month")] if month else []))
    replies = (live.filter(F.col("parent_id").startswith(COMMENT_PREFIX))
               .select(F.col("parent_id").alias("_key"), F.col("id").alias("RespId"),
                       F.col("author").alias("RespAuth"), F.col("score").alias("RespScore"),
                       F.col("ups").alias("RespUps"), F.col("downs").alias("RespDowns"),
                       F.col("controversiality").alias("RespControv"),
                       *([F.col(month).alias("resp_month")] if month else [])))
    return parents, replies


def reply_edges(comments: DataFrame) -> DataFrame:
    """One edge per reply: parent comment -> reply, both authors known.

    Equi-join on ``'t1_' || parent.id = reply.parent_id``.  Only replies to a
    comment can match, so the reply side is pre-filtered on the ``t1_`` prefix
    (pushed into the scan) before the shuffle.  Each parent id is unique, so a
    heavily answered comment skews only the reply side; AQE's skew-join split
    cuts such a partition into several tasks, each joined with the single
    parent row.  Self-replies are kept; parent and reply may lie in
    different months.
    """
    parents, replies = _edge_sides(comments)
    return parents.join(replies, "_key", "inner").select(*EDGE_COLUMNS)


def month_edges(stored: DataFrame, month: int) -> DataFrame:
    """Every edge of the stored comments with an end in ``month`` (yyyymm): new
    replies to parents of any month, and old replies to new parents.  The
    columns ``resp_month`` and ``orig_month`` name the months of both ends.

    ``stored`` has the comments of all months, with their ``month_id``.  Old
    comments are first narrowed to those that a new one points to, or that
    point to a new one, by semi-joins over the key column alone, so adding a
    month costs about a month.
    """
    parents, replies = _edge_sides(stored, "month_id")
    new_parents, old_parents = (parents.filter(F.col("orig_month") == month), parents.filter(F.col("orig_month") != month))
    new_replies, old_replies = (replies.filter(F.col("resp_month") == month), replies.filter(F.col("resp_month") != month))
    asked = old_parents.join(new_replies.select("_key").distinct(), "_key", "left_semi")
    answers = old_replies.join(new_parents.select("_key").distinct(), "_key", "left_semi")
    out = new_parents.unionByName(asked).join(new_replies, "_key") \
        .unionByName(new_parents.join(answers, "_key"))
    return out.select(*EDGE_COLUMNS, "resp_month", "orig_month")


def all_month_edges(stored: DataFrame) -> DataFrame:
    """``reply_edges`` with the months of both ends."""
    parents, replies = _edge_sides(stored, "month_id")
    return parents.join(replies, "_key").select(*EDGE_COLUMNS, "resp_month", "orig_month")


def summed_degrees(deltas: DataFrame) -> DataFrame:
    """The degree table from the stored degrees of each pair of months."""
    return deltas.groupBy("kind", "subreddit", "author").agg(F.sum("rank").alias("rank"))


def degrees(edges: DataFrame, kind: str = "indegree") -> DataFrame:
    """(subreddit, author, rank): replies received (indegree) or made
    (outdegree).  A count with map-side partial aggregation, so a hot author
    or subreddit never concentrates raw rows in one task.  Every (subreddit,
    author) is kept, ties included."""
    side = DEGREE_SIDES[kind]
    return (edges.groupBy(F.col("Subreddit").alias("subreddit"), F.col(side).alias("author"))
            .agg(F.count(F.lit(1)).alias("rank")))


def ranked_degrees(edges: DataFrame, kind: str = "indegree") -> DataFrame:
    """Full ranking of every subreddit, highest rank first, ties by author.

    A global sort: range partitioning on the whole sort key cuts a huge
    subreddit across several tasks instead of funnelling it into one.
    """
    return degrees(edges, kind).orderBy("subreddit", F.col("rank").desc(), "author")


def leaders(edges: DataFrame, kind: str = "indegree") -> DataFrame:
    """Top author of every subreddit by degree (ties: smaller author name)."""
    return top_per_group(degrees(edges, kind), ["subreddit"],
                         [F.col("rank").desc(), F.col("author")], 1)


def all_degrees(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(kind, subreddit, author, rank) for both kinds from one pass over the
    edges: every edge yields an in-degree row for its parent's author and an
    out-degree row for the reply's author, and one partially aggregated
    shuffle counts both.  The self-join upstream therefore runs once.
    ``by`` adds further keys of the edges."""
    sides = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(col).alias("author"))
                      for kind, col in DEGREE_SIDES.items()])
    return (edges.select(*by, F.col("Subreddit").alias("subreddit"), F.explode(sides).alias("s"))
            .groupBy(*by, F.col("s.kind").alias("kind"), "subreddit", F.col("s.author").alias("author"))
            .agg(F.count(F.lit(1)).alias("rank")))


def engagement(edges: DataFrame) -> DataFrame:
    """Per subreddit: most influential (in-degree) and most active (out-degree)
    author, ties by smaller name.

    Both leaders come from one degree pass and one aggregation by subreddit:
    ``min(struct(-rank, author))`` per kind orders by rank descending, then
    author, and is partially aggregated before its shuffle, so a subreddit
    with millions of authors sends one row per map task.  A subreddit appears
    when it has any edge, and every edge feeds both kinds, so this equals a
    full outer join of the two leader lists.
    """
    return engagement_of(all_degrees(edges))


def engagement_of(degrees: DataFrame) -> DataFrame:
    """``engagement`` from a degree table (kind, subreddit, author, rank)."""
    best = lambda kind: F.min(F.when(F.col("kind") == kind,
                                     F.struct((-F.col("rank")).alias("neg"), F.col("author").alias("a"))))
    top = degrees.groupBy("subreddit").agg(best("indegree").alias("i"), best("outdegree").alias("o"))
    return top.select("subreddit",
                      F.col("i.a").alias("influential_user"), (-F.col("i.neg")).alias("influence"),
                      F.col("o.a").alias("active_user"), (-F.col("o.neg")).alias("activity"))


def degree_export(edges: DataFrame) -> DataFrame:
    """In- and out-degree rows together, in the download's field names (one
    degree pass, so the union costs no second join)."""
    return all_degrees(edges).select("kind", "subreddit", F.col("author").alias("user"),
                                     F.col("rank").alias("influence"))


def degree_download(edges: DataFrame, subreddit: str) -> DataFrame:
    """Every in- and out-degree row of one subreddit as JSON lines (the
    download of the engagement page; the original's non-JSON trailer is
    dropped).  The subreddit filter runs on the degree rows' grouping key, so
    Catalyst pushes it below the aggregation to the edges."""
    rows = degree_export(edges).filter(F.col("subreddit") == subreddit)
    return rows.select(F.to_json(F.struct("kind", "subreddit", "user", "influence")).alias("value"))


def engage_response(edges_engagement: DataFrame, trend: DataFrame, recommendations: DataFrame) -> DataFrame:
    """What the engage page answers for every subreddit: its leaders, its
    monthly trend and the recommended subreddits, one row each.  ``trend`` has
    at most one row per month and ``recommendations`` a few per subreddit, so
    the collected lists are bounded."""
    months = trend.groupBy("subreddit").agg(F.array_sort(F.collect_list(F.struct(
        "year", "month", "total_comments"))).alias("t"))
    months = months.select("subreddit", F.concat_ws(",", F.transform("t", lambda x: F.concat_ws(
        ":", F.concat_ws("-", x["year"], x["month"]), x["total_comments"]))).alias("trend"))
    recs = recommendations.groupBy(F.col("seed").alias("subreddit")).agg(F.array_sort(F.collect_list(F.struct(
        "position", F.col("subreddit").alias("name")))).alias("r"))
    recs = recs.select("subreddit", F.concat_ws(",", F.col("r.name")).alias("recommended"))
    return (edges_engagement.join(months, "subreddit", "left").join(recs, "subreddit", "left")
            .withColumn("trend", F.coalesce("trend", F.lit("")))
            .withColumn("recommended", F.coalesce("recommended", F.lit(""))))

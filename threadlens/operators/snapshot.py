"""Snapshot: monthly per-subreddit statistics and their views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.timefmt import utc_month, utc_year
from threadlens.operators.common import top_per_group

STAT_COLUMNS = ["year", "month", "subreddit", "total_comments", "distinct_authors",
                "distinct_submissions", "comments_per_distinct_author",
                "comments_per_distinct_submission"]


def monthly_stats(comments: DataFrame, exact: bool = True, rsd: float = 0.02) -> DataFrame:
    """Comments, distinct authors and distinct submissions per (year, month,
    subreddit), with the two ratios.

    The two exact distinct counts compile to one Expand + two-level hash
    aggregate: partial aggregation dedupes (group, value) pairs inside each map
    task, and the shuffle key includes the distinct value, so a hot subreddit
    is spread over many reducers.  A ratio with no distinct value is NULL.

    ``exact=False`` swaps both distinct counts for HyperLogLog sketches
    (``approx_count_distinct`` with relative error ``rsd``): one fixed-size
    buffer per group and no Expand, for dashboards over the full history.
    """
    distinct = (lambda c, name: F.count_distinct(c).alias(name)) if exact else \
        (lambda c, name: F.approx_count_distinct(c, rsd).alias(name))
    grouped = (comments
               .select(utc_year("created_utc").alias("year"), utc_month("created_utc").alias("month"),
                       "subreddit", "author", "link_id")
               .groupBy("year", "month", "subreddit")
               .agg(F.count(F.lit(1)).alias("total_comments"),
                    distinct("author", "distinct_authors"),
                    distinct("link_id", "distinct_submissions")))
    return grouped.select(
        *STAT_COLUMNS[:6],
        F.try_divide(F.col("total_comments").cast("double"), F.col("distinct_authors"))
         .alias("comments_per_distinct_author"),
        F.try_divide(F.col("total_comments").cast("double"), F.col("distinct_submissions"))
         .alias("comments_per_distinct_submission"))


def top_subreddits_per_month(stats: DataFrame, n: int = 100) -> DataFrame:
    """The subredditinfo table: the ``n`` busiest subreddits of every month,
    ties by name."""
    return top_per_group(stats, ["year", "month"],
                         [F.col("total_comments").desc(), F.col("subreddit")], n)


def month_view(table: DataFrame, year: int, month: int) -> DataFrame:
    """One month of the table with display names; the (year, month) filter is
    on the window's partition keys, so Catalyst pushes it below the ranking."""
    return (table.filter((F.col("year") == year) & (F.col("month") == month))
            .select("subreddit",
                    F.col("total_comments").alias("totalComments"),
                    F.col("distinct_authors").alias("distinctAuthors"),
                    F.col("distinct_submissions").alias("distinctSubmission"),
                    F.col("comments_per_distinct_author").alias("commentsPerDAuthor"),
                    F.col("comments_per_distinct_submission").alias("commentsPerDSubmission"),
                    F.lit(year).cast("bigint").alias("year"),
                    F.lit(month).cast("bigint").alias("month")))


def subreddit_trend(table: DataFrame, subreddit: str) -> DataFrame:
    """Month series of one subreddit, oldest first, with a ``year-month`` label."""
    return (table.filter(F.col("subreddit") == subreddit)
            .select("year", "month", "total_comments", "distinct_authors",
                    F.concat_ws("-", "year", "month").alias("label"))
            .orderBy("year", "month"))

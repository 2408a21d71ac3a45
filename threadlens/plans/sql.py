"""The SQL face of the library: temp views over DataFrames and SQL text for
users who query with ``spark.sql``.  Catalyst plans the text exactly like the
DataFrame version of the same query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlens.operators.graph import DEGREE_SIDES, reply_edges


def register_views(spark: SparkSession, comments: DataFrame) -> None:
    """``comments`` and ``reply_edges`` as temp views."""
    comments.createOrReplaceTempView("comments")
    reply_edges(comments).createOrReplaceTempView("reply_edges")


def snapshot_sql(n: int = 100) -> str:
    """Monthly subreddit statistics, ``n`` busiest per month (zone-free month)."""
    return f"""
    SELECT year, month, subreddit, total_comments, distinct_authors, distinct_submissions,
           comments_per_distinct_author, comments_per_distinct_submission
    FROM (
      SELECT *, row_number() OVER (PARTITION BY year, month
                                   ORDER BY total_comments DESC, subreddit) AS rn
      FROM (
        SELECT CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month, subreddit,
               count(*) AS total_comments,
               count(DISTINCT author) AS distinct_authors,
               count(DISTINCT link_id) AS distinct_submissions,
               try_divide(CAST(count(*) AS DOUBLE), count(DISTINCT author)) AS comments_per_distinct_author,
               try_divide(CAST(count(*) AS DOUBLE), count(DISTINCT link_id)) AS comments_per_distinct_submission
        FROM (SELECT date_from_unix_date(CAST(floor(created_utc / 86400) AS INT)) AS d, subreddit, author,
                     link_id FROM comments)
        GROUP BY 1, 2, 3))
    WHERE rn <= {n}"""


def degrees_sql() -> str:
    """Every author's replies received and made per subreddit, both kinds from
    one pass over the ``reply_edges`` view."""
    ends = ", ".join(f"'{kind}', {author}" for kind, author in DEGREE_SIDES.items())
    return f"""
    SELECT side.kind, e.Subreddit AS subreddit, side.author, count(*) AS rank
    FROM reply_edges e, LATERAL (SELECT stack({len(DEGREE_SIDES)}, {ends}) AS (kind, author)) side
    GROUP BY ALL"""

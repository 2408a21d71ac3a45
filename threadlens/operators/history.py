"""Flashback: an author's full history and first post."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.ids import base36_to_long, link_url, strip_fullname
from threadlens.functions.text import html_title, title_head
from threadlens.functions.timefmt import format_mdy_hms
from threadlens.operators.common import top_per_group

POST_COLUMNS = ["author", "created_utc", "body", "link_id", "subreddit"]
# Fixed value: base of discussion links.
DEFAULT_LINK_BASE = "http://www.reddit.com/"


def posts(comments: DataFrame) -> DataFrame:
    """The firstpost table: every post, five columns."""
    return comments.select(*POST_COLUMNS)


def author_posts(comments: DataFrame, author: str) -> DataFrame:
    """All posts of one author (keyed read; the equality filter reaches the
    Parquet scan as a pushed filter)."""
    return posts(comments).filter(F.col("author") == F.lit(author))


def author_history(comments: DataFrame, author: str) -> DataFrame:
    """Posts of an author in clustering order (created_utc ascending)."""
    return author_posts(comments, author).orderBy("created_utc", "link_id", "body")


def author_count(comments: DataFrame, author: str) -> DataFrame:
    """``SELECT count(*) ... WHERE author = ?`` as a one-row frame."""
    return (comments.filter(F.col("author") == F.lit(author))
            .agg(F.count(F.lit(1)).alias("n_comments")))


def first_posts(comments: DataFrame) -> DataFrame:
    """First post of every author: earliest created_utc, ties by smaller id code.

    Planned as a partial per-task top-1 (WindowGroupLimit) ahead of the
    shuffle, so a prolific author contributes one row per map task.
    """
    ranked = comments.select(*POST_COLUMNS, base36_to_long("id").alias("_code"))
    return top_per_group(ranked, ["author"], [F.col("created_utc"), F.col("_code")], 1).drop("_code")


def first_post_view(first: DataFrame, link_base: str = DEFAULT_LINK_BASE) -> DataFrame:
    """Display form: formatted UTC time and discussion link."""
    return first.select(
        "author",
        format_mdy_hms("created_utc").alias("posted_at"),
        F.col("body").alias("post"),
        strip_fullname("link_id").alias("submission"),
        link_url("link_id", link_base).alias("discussion_url"),
        "subreddit")


def history_export(comments: DataFrame, author: str) -> DataFrame:
    """Download form of the history: one JSON object per line."""
    rows = author_posts(comments, author).select(
        "author", F.col("created_utc").alias("posted_at"), F.col("body").alias("post"),
        F.col("link_id").alias("discussion"), "subreddit")
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def page_titles(pages: DataFrame) -> DataFrame:
    """Title of every page, cut at its first ``:``."""
    return pages.select("page_id", "url", title_head(html_title("html")).alias("title"))


def post_titles(first: DataFrame, pages: DataFrame) -> DataFrame:
    """Resolve each first post's submission to a page title.

    The submission id (base 36 after ``t3_``) is the page key; pages are
    pruned to (page_id, html) before the join, and the join is an equi-join
    that AQE may turn into a broadcast when the page side is small.
    """
    keyed = first.withColumn("page_id", base36_to_long(strip_fullname("link_id")))
    titles = pages.select("page_id", title_head(html_title("html")).alias("title"))
    return (keyed.join(titles, "page_id", "left")
            .select("author", "created_utc", "link_id", "subreddit", "page_id", "title"))

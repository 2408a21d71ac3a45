"""Statistics that add up: stored sketches in place of the comments.

``monthly_sketches`` keeps, per month and subreddit, the number of comments and
a HyperLogLog sketch each of its authors and submissions; quarters, years and
all time are unions of stored rows, and no comment is read again.  Exact
distinct counts can't be added up, as an author returns in every month.

``slot_sketches`` keeps the frequent authors of a slot in a bounded sketch;
the sketches of minutes combine to those of hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.timefmt import slot_of_epoch, slot_start, utc_month, utc_year
from threadlens.operators.common import top_per_group
from threadlens.operators.live import TOP_K

#: 2^14 registers: a relative standard error of 1.04 / sqrt(2^14), 0.8 percent.
LG_K = 14
RELATIVE_ERROR = 1.04 / (1 << LG_K) ** 0.5

#: Items that a slot's sketch tracks.  Counts are exact as long as a slot has
#: no more than three quarters of it in distinct names.
TRACKED = 4096


def monthly_sketches(comments: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(year, month, subreddit, comments, authors, submissions): the last two
    are sketches of at most 2^lg_k bytes or so, whatever the group's size."""
    return comments.select(utc_year("created_utc").alias("year"), utc_month("created_utc").alias("month"),
                           "subreddit", "author", "link_id") \
        .groupBy("year", "month", "subreddit").agg(
            F.count(F.lit(1)).alias("comments"), F.hll_sketch_agg("author", F.lit(lg_k)).alias("authors"),
            F.hll_sketch_agg("link_id", F.lit(lg_k)).alias("submissions"))


def rolled_up(sketches: DataFrame, period: Column) -> DataFrame:
    """Statistics per (period, subreddit) from stored monthly rows."""
    rows = sketches.groupBy(period.alias("period"), "subreddit").agg(
        F.sum("comments").alias("total_comments"),
        F.hll_sketch_estimate(F.hll_union_agg("authors")).alias("distinct_authors"),
        F.hll_sketch_estimate(F.hll_union_agg("submissions")).alias("distinct_submissions"))
    return rows.withColumn("comments_per_distinct_author",
                           F.try_divide(F.col("total_comments").cast("double"), F.col("distinct_authors")))


def all_periods(sketches: DataFrame) -> DataFrame:
    """Quarters, years and all time, each a union of stored months."""
    year = F.col("year").cast("string")
    quarter = F.concat(year, F.lit("-Q"), F.ceil(F.col("month") / 3).cast("string"))
    each = sketches.withColumn("__period", F.explode(F.array(quarter, year, F.lit("all"))))
    return rolled_up(each, F.col("__period"))


def slot_sketches(records: DataFrame, key: str, time_col: str = "arrived_at", slot_seconds: int = 60,
                  tracked: int = TRACKED) -> DataFrame:
    """(slot_start, comments, names): a frequent-items sketch per slot, built by
    partial aggregation, so a slot is never in one task."""
    return records.dropna(subset=["author", "subreddit", time_col]) \
        .select(slot_start(time_col, slot_seconds).alias("slot_start"), F.col(key).alias("name")) \
        .groupBy("slot_start").agg(F.count(F.lit(1)).alias("comments"),
                                   F.expr(f"approx_top_k_accumulate(name, {tracked})").alias("names"))


def combined(sketches: DataFrame, slot_seconds: int, tracked: int = TRACKED) -> DataFrame:
    """Sketches of shorter slots combined to slots of ``slot_seconds``."""
    start = F.col("slot_start") - F.pmod("slot_start", F.lit(slot_seconds))
    return sketches.select(start.alias("slot_start"), "comments", "names").groupBy("slot_start") \
        .agg(F.sum("comments").alias("comments"), F.expr(f"approx_top_k_combine(names, {tracked})").alias("names"))


def estimated_top(sketches: DataFrame, key: str, k: int = TOP_K, tracked: int = TRACKED) -> DataFrame:
    """The ``k`` largest estimated counts of each slot, ranked, ties by name
    (all tracked names are ranked, as the estimate itself cuts ties anyhow)."""
    items = F.explode(F.expr(f"approx_top_k_estimate(names, {tracked})")).alias("i")
    rows = sketches.select(slot_of_epoch("slot_start", 1).alias("minuteslot"), items) \
        .select("minuteslot", F.col("i.item").alias(key), F.col("i.count").alias("count"))
    return top_per_group(rows, ["minuteslot"], [F.col("count").desc(), F.col(key)], k, position="rank")

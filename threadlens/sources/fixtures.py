"""The driver's tables mapped onto the comment data model.

No driver table is a comment dump, so ``events`` is mapped row by row onto
typed comments (see FIXTURES.md): a thread is 25 consecutive events in one
subreddit, replies stay in their thread, and threads are shifted by 0, 183 or
366 days so the data spans three months over two years.  The mapping is pure
column arithmetic, so it stays a narrow projection over the events scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.ids import COMMENT_PREFIX, SUBMISSION_PREFIX, long_to_base36
from threadlens.functions.timefmt import epoch_seconds
from threadlens.sources.schema import COMMENT_COLUMNS

# Fixed values of the fixture mapping (FIXTURES.md, F2); they must stay as written
# for the Spark jobs and the DuckDB oracle to agree.
THREAD_SIZE = 25
DELETED_USER_MODULUS = 37
DELETED_AUTHOR = "[deleted]"
SHIFT_SECONDS = 15811200          # 183 days
SHIFT_STEPS = 3
RETRIEVED_DELAY = 86400
SUBREDDIT_SPREAD = 150
SUBREDDIT_PREFIX = "sub_"
SUBREDDIT_ID_PREFIX = "t5_"
REPLY_WINDOW = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _thread_bucket(thread: Column) -> Column:
    h = F.conv(F.substring(F.md5(thread.cast("string")), 1, 8), 16, 10).cast("bigint")
    return h % (F.lit(1) + F.floor(h / F.lit(1000)) % F.lit(SUBREDDIT_SPREAD))


def comments_from_events(events: DataFrame, with_arrival: bool = False) -> DataFrame:
    """Typed comments (created_utc bigint, last) derived from ``events``.

    ``with_arrival`` adds ``offset`` (event_id) and ``arrived_at`` (events.ts as
    epoch seconds), the message position and arrival time of the live feed.
    """
    eid = F.col("event_id")
    thread = F.expr(f"event_id div {THREAD_SIZE}")
    shift = (thread % F.lit(SHIFT_STEPS)) * F.lit(SHIFT_SECONDS)
    arrival = epoch_seconds("ts")
    parent_code = F.greatest(eid - eid % F.lit(THREAD_SIZE), eid - F.lit(1) - eid % F.lit(REPLY_WINDOW))
    bucket = _thread_bucket(thread)
    cols = {
        "archived": eid % 2 == 0,
        "author": F.when(F.col("user_id") % DELETED_USER_MODULUS == 0, F.lit(DELETED_AUTHOR))
                   .otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))),
        "author_flair_css_class": F.lit(None).cast("string"),
        "body": F.col("props"),
        "controversiality": F.when(F.col("event_type") == "error", 1).otherwise(0).cast("bigint"),
        "distinguished": F.lit(None).cast("string"),
        "downs": eid % 3,
        "edited": F.when(eid % 5 == 0, F.lit("true")).otherwise(F.lit("false")),
        "gilded": F.when(F.col("event_type") == "purchase", 1).otherwise(0).cast("bigint"),
        "id": long_to_base36(eid),
        "link_id": F.concat(F.lit(SUBMISSION_PREFIX), long_to_base36(thread)),
        "name": F.concat(F.lit(COMMENT_PREFIX), long_to_base36(eid)),
        "parent_id": F.when((eid % THREAD_SIZE == 0) | (eid % 3 == 0),
                            F.concat(F.lit(SUBMISSION_PREFIX), long_to_base36(thread)))
                      .otherwise(F.concat(F.lit(COMMENT_PREFIX), long_to_base36(parent_code))),
        "retrieved_on": arrival + shift + F.lit(RETRIEVED_DELAY),
        "score": F.col("value").cast("bigint"),
        "score_hidden": F.lit(False),
        "subreddit": F.concat(F.lit(SUBREDDIT_PREFIX), bucket.cast("string")),
        "subreddit_id": F.concat(F.lit(SUBREDDIT_ID_PREFIX), bucket.cast("string")),
        "ups": F.col("value").cast("bigint") + eid % 3,
        "created_utc": arrival + shift,
    }
    out = [cols[c].alias(c) for c in COMMENT_COLUMNS]
    if with_arrival:
        out += [eid.alias("offset"), arrival.alias("arrived_at")]
    return events.select(*out)


def load_comments(spark: SparkSession, sf_dir: str, with_arrival: bool = False) -> DataFrame:
    return comments_from_events(table(spark, sf_dir, "events"), with_arrival=with_arrival)


def block_list_from_comments(comments: DataFrame) -> DataFrame:
    """Test block list of FIXTURES.md F11: subreddits whose name ends in 7."""
    return (comments.select(F.col("subreddit").alias("name"))
            .filter(F.col("name").endswith("7")).distinct())

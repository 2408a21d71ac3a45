"""Live feed in batch form: the same transforms the streaming jobs apply per
micro-batch, usable on landed data and checked against the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.ids import base36_to_long, link_url
from threadlens.functions.timefmt import day_label, display_time, second_slot, slot_label, slot_of_epoch, slot_start
from threadlens.operators.common import top_per_group
from threadlens.operators.history import DEFAULT_LINK_BASE
from threadlens.sources.schema import CORRUPT_COLUMN, STREAM_PARSE_SCHEMA, STREAM_RECORD_SCHEMA

# Fixed values of the live products: top list length, read lags, retention.
TOP_K = 20
TREND_LAG_SECONDS = 120
FEED_LAG_SECONDS = 60
FEED_ROWS = 20
TREND_TTL_SECONDS = 300
FEED_TTL_SECONDS = 180
PAGE_SIZE = 100


def stream_records(comments: DataFrame, link_base: str = DEFAULT_LINK_BASE,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """The eight fields a live comment is published with (plus ``keep``)."""
    return comments.select(
        "author", "parent_id", "score", "name", "subreddit",
        link_url("link_id", link_base).alias("link_url"), "created_utc", "body", *keep)


def to_messages(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON string per record (``value``), as a message-bus producer sends it."""
    fields = [f.name for f in STREAM_RECORD_SCHEMA.fields]
    return records.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text -> record columns; a malformed message keeps its text in
    ``_corrupt_record`` (the struct itself is never NULL, so test that column)."""
    parsed = F.from_json(F.col(value).cast("string"), STREAM_PARSE_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    rest = [c for c in messages.columns if c != value]
    return messages.select(*rest, F.col(value).cast("string").alias("_raw"), parsed.alias("m")) \
                   .select(*rest, "_raw", "m.*")


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN, "_raw")


def dead_letters(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages that did not parse, split off instead of failing the job."""
    return parsed.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(*keep, F.col("_raw").alias("message"))


def slot_counts(records: DataFrame, key: str, time_col: str = "created_utc",
                slot_seconds: int = 60, with_start: bool = False) -> DataFrame:
    """Comments per (slot, key); rows without an author or subreddit are
    skipped for every key, as the live counter does."""
    start = slot_start(time_col, slot_seconds)
    keys = [slot_of_epoch(time_col, slot_seconds).alias("minuteslot"), F.col(key)]
    if with_start:
        keys.insert(0, start.alias("slot_start"))
    return (records.dropna(subset=["author", "subreddit", time_col])
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).cast("int").alias("count")))


def top_per_slot(counts: DataFrame, key: str, k: int = TOP_K) -> DataFrame:
    """The ``k`` largest counts of every slot, ranked descending, ties by key."""
    return top_per_group(counts, ["minuteslot"], [F.col("count").desc(), F.col(key)], k,
                         position="rank")


def minute_trends(records: DataFrame, key: str, time_col: str = "arrived_at",
                  slot_seconds: int = 60, k: int = TOP_K) -> DataFrame:
    return top_per_slot(slot_counts(records, key, time_col, slot_seconds), key, k)


def read_trend_slot(table: DataFrame, key: str, as_of: int, lag: int = TREND_LAG_SECONDS,
                    slot_seconds: int = 60, k: int = TOP_K) -> DataFrame:
    """Top list of the slot ``lag`` seconds before ``as_of`` (epoch seconds),
    largest first, from a stored trend table.  The day and the slot's label are
    known numbers, so one ``day`` folder is opened and the label is pushed into
    its files.  A slot starts on the day that its folder names."""
    at = as_of - lag
    return (table.filter((F.col("day") == day_label(at // slot_seconds * slot_seconds))
                         & (F.col("minuteslot") == slot_label(at, slot_seconds)))
            .orderBy(F.col("count").desc(), F.col(key)).limit(k).select("minuteslot", key, "count", "rank"))


def feed_rows(records: DataFrame, time_col: str = "arrived_at") -> DataFrame:
    """Feed table: arrival second plus the displayed fields."""
    return records.select(second_slot(time_col).alias("secslot"), "subreddit", "author",
                          "created_utc", "body", display_time("created_utc").alias("posted_at"))


def read_feed(feed: DataFrame, as_of: int, lag: int = FEED_LAG_SECONDS, rows: int = FEED_ROWS) -> DataFrame:
    """The comments that arrived in the second ``lag`` before ``as_of`` (20 at
    most), from the stored feed; only that second's ``day`` folder is read."""
    at = as_of - lag
    return (feed.filter((F.col("day") == day_label(at)) & (F.col("secslot") == at))
            .orderBy("created_utc", "author", "body").limit(rows)
            .select("secslot", "subreddit", "author", "created_utc", "body", "posted_at"))


def retained(table: DataFrame, slot_col: str, as_of_col: Column, ttl: int,
             slot_seconds: int = 60) -> DataFrame:
    """Rows still alive at ``as_of`` under a time-to-live (a read-side filter)."""
    return table.filter(F.col(slot_col) + F.lit(slot_seconds) > as_of_col - F.lit(ttl))


# ---- polled listing pages ------------------------------------------------

def pages_from_records(comments: DataFrame, overlap: int = 10, page_size: int = PAGE_SIZE) -> DataFrame:
    """Nested listing pages as a poller lands them.

    Comment ``offset`` o goes to page o div page_size, and the last ``overlap``
    comments of each page are repeated at the head of the next one, like
    overlapping polls.  A page holds at most ``page_size + overlap`` comments,
    so the per-page ``collect_list`` is bounded by construction.
    """
    page = F.expr(f"offset div {page_size}")
    base = comments.withColumn("page", page)
    repeat = (comments.filter(F.expr(f"offset % {page_size} >= {page_size - overlap}"))
              .withColumn("page", page + F.lit(1)))
    child = F.struct(F.lit("t1").alias("kind"),
                     F.struct("id", "name", "author", "subreddit", "parent_id", "link_id", "body",
                              "score", "created_utc").alias("data"))
    return (base.unionByName(repeat)
            .groupBy("page")
            .agg(F.max("arrived_at").alias("polled_at"),
                 F.sort_array(F.collect_list(F.struct(F.col("offset"), child.alias("c"))))
                  .alias("items"))
            .select("page", "polled_at",
                    F.struct(F.transform("items", lambda x: x["c"]).alias("children")).alias("data")))


def flatten_pages(pages: DataFrame) -> DataFrame:
    """Listing pages -> one row per comment, with its base-36 ordering code."""
    return (pages.select("page", "polled_at", F.explode("data.children").alias("child"))
            .select("page", "polled_at", "child.data.*")
            .withColumn("code", base36_to_long("id")))


def new_comments(rows: DataFrame, last_code: Column | int) -> DataFrame:
    """Comments above a high-water mark, each once, in code order.  Rows below
    the mark go before the repeats are collapsed, so only new comments are
    shuffled."""
    mark = last_code if isinstance(last_code, Column) else F.lit(last_code)
    return distinct_comments(rows.filter(F.col("code") > mark)).orderBy("code")


def high_water(rows: DataFrame, max_lag: int = 0) -> DataFrame:
    """Per page: highest code, newest id, lag of the newest comment behind the
    poll time, and whether a poller would skip ahead."""
    agg = (rows.groupBy("page")
           .agg(F.max("code").alias("max_code"),
                F.max_by("id", "code").alias("newest_id"),
                F.max_by("created_utc", "code").alias("newest_created"),
                F.max("polled_at").alias("polled_at")))
    lag = F.col("polled_at") - F.col("newest_created")
    return agg.select("page", "max_code", "newest_id", "newest_created",
                      lag.alias("lag_seconds"),
                      ((F.lit(max_lag) > 0) & (lag > F.lit(max_lag))).alias("skipping"))


def unseen_comments(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Comments of landed pages that a stored, de-duplicated table lacks: the
    rows that a streaming watermark has dropped as late, to report or append."""
    return distinct_comments(rows).join(stored.select("id"), "id", "left_anti")


def distinct_comments(rows: DataFrame) -> DataFrame:
    """Overlapping polls collapsed to one row per comment id."""
    return rows.dropDuplicates(["id"]).drop("page", "polled_at")


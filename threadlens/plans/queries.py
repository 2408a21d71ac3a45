"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed over the whole of the driver's tables.

Parameters below are the ones the driver's correctness run uses; every one
is also a keyword of the underlying operator.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.ids import base36_to_long
from threadlens.functions.timefmt import day_label, utc_month, utc_year
from threadlens.operators import bucketed, graph, history, live, recommend, sink, sketches, snapshot
from threadlens.session import scratch_path
from threadlens.sources import drift, fixtures, json_source, lists
from threadlens.sources.schema import COMMENT_COLUMNS, FEED_PAGE_SCHEMA, RAW_COMMENT_SCHEMA
from threadlens.streaming import dump_stream, high_water, live_stream, ticks

# Query parameters of the correctness run.
AUTHOR = "u8"
SNAPSHOT_TOP_N = 20          # the driver's cut; the stored table keeps 100
TABLE_TOP_N = 100
MONTH = (2024, 7)
TREND_SUBREDDIT = "sub_0"
HIGH_WATER_PAGE = 1
DEAD_LETTER_EVERY = 97
ALS_TOP_N = 10
HOUR = 3600
AUDIT_MODULUS = 997          # small, so that the audit finds collisions
MAX_LAG = 1_000_000          # splits the fixture's pages by their lag
# Replay of the live topic (FIXTURES F14): message ``offset`` arrives at
# REPLAY_START + offset * seconds div messages, one minute before midnight first.
REPLAY_START = 1704153540
MINUTE_RATE = (15, 1)        # 15 messages a second: a minute has over 20 subreddits
HOUR_RATE = (1, 10)          # a message every 10 seconds: an hour has over 20 authors
FEED_RATE = (50, 1)          # 50 messages a second: the feed's cap of 20 rows cuts
MINUTE_DELAY = 5
HOUR_DELAY = 120


def _comments(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.load_comments(spark, sf)


def _records(spark: SparkSession, sf: str, rate: tuple[int, int] = MINUTE_RATE) -> DataFrame:
    """Live records with their message offset and arrival second."""
    messages, seconds = rate
    at = F.expr(f"cast({REPLAY_START} + offset * {seconds} div {messages} as bigint)")
    comments = fixtures.load_comments(spark, sf, with_arrival=True).withColumn("arrived_at", at)
    return live.stream_records(comments, keep=("offset", "arrived_at"))


def _newest(spark: SparkSession, sf: str, rate: tuple[int, int]) -> int:
    """The last arrival: the replay's "now", a single number."""
    return _records(spark, sf, rate).agg(F.max("arrived_at")).first()[0] or REPLAY_START


def _last_closed(newest: int, slot_seconds: int, delay: int) -> int:
    return (newest - delay) // slot_seconds * slot_seconds - slot_seconds


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.reply_edges(_comments(spark, sf))


def _stats_table(spark: SparkSession, sf: str, n: int = TABLE_TOP_N) -> DataFrame:
    return snapshot.top_subreddits_per_month(snapshot.monthly_stats(_comments(spark, sf)), n)


# ---- ingest / history -------------------------------------------------------

def _land_dump(comments: DataFrame, path: str) -> None:
    (comments.withColumn("created_utc", F.col("created_utc").cast("string"))
     .select(*RAW_COMMENT_SCHEMA.fieldNames()).write.json(path))


def _read_ingested(spark, path):
    back = json_source.read_comments_parquet(spark, path)
    return back.select(*COMMENT_COLUMNS, F.col("year").cast("bigint").alias("year"),
                       F.col("month").cast("bigint").alias("month"))


def q_ingest(spark, sf):
    """The ingest job: raw JSON lines -> declared-schema read -> cast ->
    month-partitioned Parquet + dead letters; read back."""
    raw_dir = scratch_path(spark, "raw-json")
    # land the dump as several files, as monthly dumps arrive
    _land_dump(_comments(spark, sf).repartition(4), raw_dir)
    out, dead = scratch_path(spark, "comments-parquet"), scratch_path(spark, "dead-letters")
    json_source.ingest(spark, raw_dir, out, dead)
    return _read_ingested(spark, out)


def q_ingest_months(spark, sf):
    """Monthly dumps ingested one by one, the second of them twice; each row
    with the name of the dump that it came from."""
    root, out, dead = (scratch_path(spark, n) for n in ("month-dumps", "month-comments", "month-dead"))
    comments = json_source.with_month(_comments(spark, sf))
    months = sorted((r[0], r[1]) for r in comments.select("year", "month").distinct().collect())
    for year, month in [*months[:2], *months[1:2], *months[2:]]:
        dump = f"{root}/{uuid.uuid4().hex[:8]}/RC_{year}-{month:02d}"
        _land_dump(comments.filter((F.col("year") == year) & (F.col("month") == month)), dump)
        json_source.ingest(spark, dump, out, dead, mode="replace")
    names = json_source.read_raw_comments(spark, f"{root}/*/RC_*", keep_corrupt=False, with_source=True)
    return _read_ingested(spark, out).join(names.select("id", "source_file").distinct(), "id")


def q_ingest_stream(spark, sf):
    """Monthly dumps dropped into a folder and found by three runs of the
    ingest stream, with a fourth run that finds nothing."""
    landing, out, dead, ckpt = (scratch_path(spark, n) for n in ("landing", "streamed", "streamed-dead", "streamed-ckpt"))
    comments = json_source.with_month(_comments(spark, sf))
    months = sorted((r[0], r[1]) for r in comments.select("year", "month").distinct().collect())
    for year, month in [*months, (0, 0)]:
        part = comments.filter((F.col("year") == year) & (F.col("month") == month))
        if year:
            _land_dump(part, f"{landing}/RC_{year}-{month:02d}")
        dump_stream.start_ingest_stream(spark, landing, out, dead, ckpt).awaitTermination()
    return _read_ingested(spark, out)


def q_schema_drift(spark, sf):
    """Two kinds of dump: the later one has lost a field and gained two; both
    are read by one job, the new fields by their paths."""
    root = scratch_path(spark, "drifting")
    rows = _comments(spark, sf).withColumn("created_utc", F.col("created_utc").cast("string")).withColumn(
        "code", base36_to_long("id"))
    raw = RAW_COMMENT_SCHEMA.fieldNames()
    rows.filter("code % 2 = 0").select(*raw).write.json(f"{root}/RC_old")
    rows.filter("code % 2 = 1").select(*[c for c in raw if c != "gilded"], F.struct(
        (F.col("code") % 7).alias("gold"), F.lit("x").alias("kind")).alias("awards"),
        (F.col("code") % 3 == 0).alias("stickied")).write.json(f"{root}/RC_new")
    found = drift.read_with_variant(spark, f"{root}/*")
    return found.select("id", "author", "created_utc", "gilded", "source_file",
                        drift.field("$.awards.gold", "bigint").alias("gold"),
                        drift.field("$.stickied", "boolean").alias("stickied"))


def q_author_count(spark, sf):
    return history.author_count(_comments(spark, sf), AUTHOR)


def q_history(spark, sf):
    return history.author_history(_comments(spark, sf), AUTHOR)


def q_history_json(spark, sf):
    return history.history_export(_comments(spark, sf), AUTHOR)


def q_first_post(spark, sf):
    return history.first_post_view(history.first_posts(_comments(spark, sf)))


def q_page_title(spark, sf):
    return history.page_titles(fixtures.table(spark, sf, "pages"))


def q_post_titles(spark, sf):
    return history.post_titles(history.first_posts(_comments(spark, sf)),
                               fixtures.table(spark, sf, "pages"))


# ---- snapshot ---------------------------------------------------------------

def q_snapshot(spark, sf):
    return _stats_table(spark, sf, SNAPSHOT_TOP_N)


def _stored_stats(spark, sf) -> DataFrame:
    """The snapshot job's table: folders by month, files sorted by size."""
    from threadlens import jobs
    root = scratch_path(spark, "snapshot")
    comments = f"{root}/comments"
    json_source.write_comments_parquet(_comments(spark, sf), comments)
    jobs.snapshot_job(spark, comments, root, TABLE_TOP_N)
    return spark.read.parquet(f"{root}/subredditinfo")


def q_snapshot_month(spark, sf):
    """One month of the stored table: one folder is read."""
    return snapshot.month_view(_stored_stats(spark, sf), *MONTH)


def q_trend(spark, sf):
    """One subreddit's months from the stored table: the name is pushed down."""
    trend = snapshot.subreddit_trend(_stored_stats(spark, sf), TREND_SUBREDDIT)
    return trend.withColumns({c: F.col(c).cast("bigint") for c in ("year", "month")})


def q_snapshot_sql(spark, sf):
    """The snapshot through temp views and ``spark.sql``."""
    from threadlens.plans import sql
    sql.register_views(spark, _comments(spark, sf))
    return spark.sql(sql.snapshot_sql(SNAPSHOT_TOP_N))


# ---- graph ------------------------------------------------------------------

def q_edges(spark, sf):
    return _edges(spark, sf)


def q_indegree(spark, sf):
    return graph.ranked_degrees(_edges(spark, sf), "indegree")


def q_outdegree(spark, sf):
    return graph.ranked_degrees(_edges(spark, sf), "outdegree")


def _leader_view(spark, sf, kind):
    return graph.leaders(_edges(spark, sf), kind).select(
        "subreddit", F.col("rank").alias("influence"), F.col("author").alias("user"))


def q_outdegree_sql(spark, sf):
    """Out-degree through the ``reply_edges`` view and ``spark.sql``."""
    from threadlens.plans import sql
    sql.register_views(spark, _comments(spark, sf))
    return spark.sql(sql.degrees_sql()).filter("kind = 'outdegree'").drop("kind")


def q_edges_bucketed(spark, sf):
    """The reply graph from stored tables that are bucketed alike."""
    name = f"replies_{uuid.uuid4().hex[:8]}"
    bucketed.store_reply_sides(_comments(spark, sf), name, scratch_path(spark, "reply-sides"), buckets=8)
    return bucketed.stored_reply_edges(spark, name)


def q_keyed_history(spark, sf):
    """An author's posts from a table with bloom filters on author and id."""
    path = scratch_path(spark, "keyed-comments")
    bucketed.write_keyed(_comments(spark, sf), path, ["author", "id"])
    return history.author_history(spark.read.parquet(path), AUTHOR)


def q_distinct_rollup(spark, sf):
    """Quarters, years and all time from stored monthly sketches."""
    path = scratch_path(spark, "month-sketches")
    sketches.monthly_sketches(_comments(spark, sf)).write.partitionBy("year", "month").parquet(path)
    return sketches.all_periods(spark.read.parquet(path)) \
        .select("period", "subreddit", "total_comments", "distinct_authors", "distinct_submissions",
                "comments_per_distinct_author")


def q_author_sketches(spark, sf):
    """The top authors of every hour, from stored sketches of its minutes."""
    path = scratch_path(spark, "minute-sketches")
    sketches.slot_sketches(_records(spark, sf, HOUR_RATE), "author").write.parquet(path)
    return sketches.estimated_top(sketches.combined(spark.read.parquet(path), HOUR), "author")


def q_fold_in(spark, sf):
    """Factors of every author folded in from the item factors, next to the
    training's own: the same within rounding."""
    counts = recommend.interaction_counts(_comments(spark, sf))
    users, items = recommend.dense_ids(counts, "author"), recommend.dense_ids(counts, "subreddit")
    ratings = recommend.dense_ratings(counts, users, items)
    model = recommend.train_als(ratings)
    folded = recommend.fold_in(model.itemFactors, ratings).withColumnRenamed("features", "own")
    gap = F.aggregate(F.zip_with("own", "features", lambda a, b: F.abs(a - b)), F.lit(0.0).cast("float"),
                      lambda a, b: F.greatest(a, b))
    return users.join(folded, "id").join(model.userFactors, "id").select("author", (gap < 1e-4).alias("same"))


def q_dense_ids(spark, sf):
    """Dense user ids given twice: to the authors of even comments, then to the
    others, who come after them."""
    authors = _comments(spark, sf).withColumn("code", base36_to_long("id"))
    known = recommend.dense_ids(authors.filter("code % 2 = 0"), "author")
    return recommend.dense_ids(authors, "author", known)


def q_dense_ratings(spark, sf):
    """Ratings over dense ids of users and items."""
    counts = recommend.interaction_counts(_comments(spark, sf))
    return recommend.dense_ratings(counts, recommend.dense_ids(counts, "author"), recommend.dense_ids(counts, "subreddit"))


def q_top_influential(spark, sf):
    return _leader_view(spark, sf, "indegree")


def q_top_active(spark, sf):
    return _leader_view(spark, sf, "outdegree")


def q_engagement(spark, sf):
    return graph.engagement(_edges(spark, sf))


def q_degree_export(spark, sf):
    return graph.degree_export(_edges(spark, sf))


def q_engage_download(spark, sf):
    return graph.degree_download(_edges(spark, sf), TREND_SUBREDDIT)


def _incremental_graph(spark, sf) -> str:
    """Graph tables built from the stored months 1, 3, 2 (in that order), one
    of them added twice."""
    from threadlens import jobs
    stored, out = scratch_path(spark, "month-store"), scratch_path(spark, "month-graph")
    comments = json_source.with_month(_comments(spark, sf))
    months = sorted((r[0], r[1]) for r in comments.select("year", "month").distinct().collect())
    order = [months[0], *months[:1:-1], *months[1:2]] if len(months) > 2 else months
    for n, (year, month) in enumerate(order):
        part = _comments(spark, sf).filter((utc_year("created_utc") == year) & (utc_month("created_utc") == month))
        json_source.write_comments_parquet(part, stored, mode="replace")
        for _ in range(2 if n == 1 else 1):
            jobs.graph_increment_job(spark, stored, out, year, month)
    return out


def q_graph_months(spark, sf):
    """In- and out-degrees of a graph grown month by month."""
    from threadlens import jobs
    return jobs.current_degrees(spark, _incremental_graph(spark, sf))


def q_engagement_months(spark, sf):
    """Leaders of a graph grown month by month."""
    return spark.read.parquet(f"{_incremental_graph(spark, sf)}/engagement")


def q_engage(spark, sf):
    """The engage page's answer for every subreddit: leaders, trend and
    recommendations.  The edges are written once for all three."""
    comments, path = _comments(spark, sf), scratch_path(spark, "edges")
    graph.reply_edges(comments).write.parquet(path)
    edges = spark.read.parquet(path)
    return graph.engage_response(graph.engagement(edges), _stats_table(spark, sf),
                                 recommend.graph_recommend(comments, edges))


# ---- recommendation -----------------------------------------------------------

def q_recommend(spark, sf):
    """Graph recommender for every subreddit, block list read from a text file."""
    comments = _comments(spark, sf)
    path = scratch_path(spark, "block-list")
    lists.write_name_list(fixtures.block_list_from_comments(comments), path)
    block = lists.read_name_list(spark, path)

    def cut(seeds: DataFrame) -> DataFrame:
        leaders = scratch_path(spark, "leaders")
        seeds.write.parquet(leaders)
        return spark.read.parquet(leaders)
    return recommend.graph_recommend(comments, graph.reply_edges(comments), block, cut=cut)


def q_user_counts(spark, sf):
    return recommend.interaction_counts(_comments(spark, sf))


def q_user_ids(spark, sf):
    return recommend.id_map(recommend.interaction_counts(_comments(spark, sf)), "author", "user")


def q_item_ids(spark, sf):
    return recommend.id_map(recommend.interaction_counts(_comments(spark, sf)), "subreddit", "product")


def q_hash_audit(spark, sf):
    return recommend.hash_audit(recommend.interaction_counts(_comments(spark, sf)), "author", AUDIT_MODULUS)


def _counts_table(spark, sf) -> DataFrame:
    path = scratch_path(spark, "interaction-counts")
    recommend.interaction_counts(_comments(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


def q_als_ratings(spark, sf):
    """The ratings that ALS trains on."""
    return recommend.als_ratings(recommend.interaction_counts(_comments(spark, sf)))


def als_lists(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Train implicit ALS, save, load, recommend top-N for every user:
    (recommendations, items)."""
    from pyspark.ml.recommendation import ALSModel
    counts = _counts_table(spark, sf)
    model = recommend.train_als(recommend.als_ratings(counts))
    path = scratch_path(spark, "als-model")
    model.write().overwrite().save(path)
    items = recommend.id_map(counts, "subreddit", "product")
    return recommend.als_recommend(ALSModel.load(path), recommend.id_map(counts, "author", "user"), items,
                                   ALS_TOP_N), items


def q_als(spark, sf):
    """The structure of the ALS lists: each author's positions, with known
    subreddits and ordered scores (``als_lists`` has the lists themselves)."""
    return recommend.als_structure(*als_lists(spark, sf))


# ---- live: pages, high-water mark, messages -----------------------------------

def _landed_pages(spark, sf) -> DataFrame:
    """Listing pages landed as JSON, then read back with the declared schema."""
    path = scratch_path(spark, "pages-json")
    live.pages_from_records(fixtures.load_comments(spark, sf, with_arrival=True)).write.json(path)
    return spark.read.schema(FEED_PAGE_SCHEMA).json(path)


def q_page_flatten(spark, sf):
    return live.flatten_pages(_landed_pages(spark, sf))


def q_new_comments(spark, sf):
    rows = live.flatten_pages(_landed_pages(spark, sf))
    mark = rows.filter(F.col("page") <= HIGH_WATER_PAGE).select(F.max("code")).scalar()
    return live.new_comments(rows, mark)


def q_high_water(spark, sf):
    return live.high_water(live.flatten_pages(_landed_pages(spark, sf)), max_lag=MAX_LAG)


def q_to_json(spark, sf):
    return live.to_messages(_records(spark, sf), keep=("offset",))


def _messages(spark, sf, rate=MINUTE_RATE) -> DataFrame:
    """Every comment as a published message (offset, arrival second, JSON)."""
    return live.to_messages(_records(spark, sf, rate), keep=("offset", "arrived_at"))


def _messages_with_junk(spark, sf, rate=MINUTE_RATE) -> DataFrame:
    """The same messages with corrupt ones mixed in (FIXTURES F8: every 97th
    offset replaced by text that is not JSON), for the dead-letter path."""
    return _messages(spark, sf, rate).withColumn(
        "value", F.when(F.col("offset") % DEAD_LETTER_EVERY == 0, F.lit("not json")).otherwise(F.col("value")))


def q_dead_letter(spark, sf):
    return live.dead_letters(live.parse_messages(_messages_with_junk(spark, sf)), keep=("offset",))


# ---- live: streams --------------------------------------------------------------

def _landed_records(spark, sf, junk: bool = False, rate=MINUTE_RATE, **options) -> str:
    """The topic as four chunks of files in offset order: four triggers."""
    path = scratch_path(spark, "records")
    live_stream.land_records((_messages_with_junk if junk else _messages)(spark, sf, rate), path, **options)
    return path


def _trend_table(spark, sf, key, slot_seconds=60, rate=MINUTE_RATE, delay=MINUTE_DELAY, **options) -> str:
    src = _landed_records(spark, sf, rate=rate, **options)
    out, ckpt = scratch_path(spark, f"trends-{key}"), scratch_path(spark, f"trends-{key}-ckpt")
    q = live_stream.start_slot_trends(live_stream.file_source(spark, src), key, out, ckpt,
                                      slot_seconds=slot_seconds, delay=f"{delay} seconds")
    q.awaitTermination()
    return out


def _stream_trends(spark, sf, key, slot_seconds=60, rate=MINUTE_RATE, delay=MINUTE_DELAY):
    out = _trend_table(spark, sf, key, slot_seconds, rate, delay)
    return live_stream.read_table(spark, out, ["minuteslot", key, "count", "rank"])


def q_minute_subreddits(spark, sf):
    return _stream_trends(spark, sf, "subreddit")


def q_minute_authors(spark, sf):
    return _stream_trends(spark, sf, "author")


def q_hour_authors(spark, sf):
    return _stream_trends(spark, sf, "author", HOUR, HOUR_RATE, HOUR_DELAY)


def q_trend_read(spark, sf):
    """Top subreddits of the minute two minutes before "now", from the stored
    table: now lies in a later slot, so the lag picks the slot."""
    table = spark.read.parquet(_trend_table(spark, sf, "subreddit"))
    now = _last_closed(_newest(spark, sf, MINUTE_RATE), 60, MINUTE_DELAY) + 30 + live.TREND_LAG_SECONDS
    return live.read_trend_slot(table, "subreddit", now)


def q_hour_trend_read(spark, sf):
    """Top authors of the hour slot two minutes before "now" (a minute after
    the hour's end), from the stored table."""
    table = spark.read.parquet(_trend_table(spark, sf, "author", HOUR, HOUR_RATE, HOUR_DELAY))
    now = _last_closed(_newest(spark, sf, HOUR_RATE), HOUR, HOUR_DELAY) + HOUR + 60
    return live.read_trend_slot(table, "author", now, slot_seconds=HOUR)


def q_trend_repair(spark, sf):
    """The topic landed newest first, so that the watermark drops most of it;
    the slots rebuilt from the archive are complete."""
    table = _trend_table(spark, sf, "subreddit", newest_first=True)
    archive = _records(spark, sf)
    compact = scratch_path(spark, "trends-compacted")
    until = _newest(spark, sf, MINUTE_RATE) - MINUTE_DELAY
    live_stream.repair_slots(spark, archive, table, compact, "subreddit", until)
    return sink.read_compacted(spark, table, compact).select("minuteslot", "subreddit", "count", "rank")


def _feed_table(spark, sf) -> str:
    src = _landed_records(spark, sf, junk=True, rate=FEED_RATE)
    feed, dead = scratch_path(spark, "feed"), scratch_path(spark, "dead")
    q = live_stream.start_feed(live_stream.file_source(spark, src), feed, dead,
                               scratch_path(spark, "feed-ckpt"))
    q.awaitTermination()
    return feed


def q_live(spark, sf):
    """Feed stream over a topic with corrupt messages (split off as dead
    letters), then the stored feed's rows of one second, a minute before "now"."""
    table = spark.read.parquet(_feed_table(spark, sf))
    return live.read_feed(table, _newest(spark, sf, FEED_RATE) - 5 + live.FEED_LAG_SECONDS)


def q_feed_compacted(spark, sf):
    """The feed after upkeep: half the topic streamed and its days compacted,
    then the other half (late rows of compacted days), then the first day
    dropped as expired."""
    half = F.col("offset") < F.lit(_records(spark, sf).count() // 2)
    messages, src = _messages(spark, sf), scratch_path(spark, "feed-records")
    feed, compact = scratch_path(spark, "feed"), scratch_path(spark, "feed-compacted")
    dead, ckpt = scratch_path(spark, "feed-dead"), scratch_path(spark, "feed-ckpt")
    for part, mode in ((half, "errorifexists"), (~half, "append")):
        live_stream.land_records(messages.filter(part), src, chunks=2, mode=mode)
        live_stream.start_feed(live_stream.file_source(spark, src), feed, dead, ckpt).awaitTermination()
        if mode == "errorifexists":
            days = [d for (d,) in sink.partitions_of(spark, feed, "day")]
            sink.compact_days(spark, feed, compact, days, ["secslot"])
    sink.expire_days(spark, [feed, compact], day_label(REPLAY_START + 86400))
    return sink.read_compacted(spark, feed, compact).select("secslot", "subreddit", "author", "created_utc", "body")


def q_archive(spark, sf):
    """Live records archived by a streaming JSON file sink, read back."""
    src = _landed_records(spark, sf)
    out = scratch_path(spark, "archive")
    q = live_stream.start_archive(live_stream.file_source(spark, src), out, scratch_path(spark, "archive-ckpt"))
    q.awaitTermination()
    schema = "author string, parent_id string, score bigint, name string, subreddit string, " \
             "link_url string, created_utc bigint, body string, offset bigint, arrived_at bigint"
    cols = [c.split()[0] for c in schema.split(", ")]
    return spark.read.schema(schema).json(out).select(*cols)


def q_ticks(spark, sf):
    """Top lists of both listeners from one stateful stream whose slots are
    closed by timers; the topic stops half-way and is taken up again from the
    checkpoint."""
    messages, src = _messages(spark, sf), scratch_path(spark, "tick-records")
    half = F.col("offset") < F.lit(_records(spark, sf).count() // 2)
    out, ckpt = scratch_path(spark, "ticks"), scratch_path(spark, "ticks-ckpt")
    for part, mode in ((half, "errorifexists"), (~half, "append")):
        live_stream.land_records(messages.filter(part), src, chunks=2, mode=mode)
        ticks.drain(ticks.start_ticks(live_stream.file_source(spark, src), out, ckpt, state_partitions=4))
    return ticks.tick_trends(spark.read.parquet(out))


def _feed_pages(spark, sf, feeds: int = 3) -> DataFrame:
    """Listing pages of several feeds: comment ``offset`` belongs to feed offset mod 3."""
    rows = fixtures.load_comments(spark, sf, with_arrival=True)
    pages = [live.pages_from_records(rows.filter(F.col("offset") % feeds == n)).withColumn("feed", F.lit(f"feed{n}"))
             for n in range(feeds)]
    return functools.reduce(DataFrame.unionByName, pages)


def q_feed_marks(spark, sf):
    """New comments of three polled feeds over four triggers, by one stored
    high-water mark per feed."""
    pages = scratch_path(spark, "feed-pages")
    live_stream.land_pages(_feed_pages(spark, sf), pages)
    out, marks, late, ckpt = (scratch_path(spark, n) for n in ("feed-new", "feed-marks", "feed-late", "feed-marks-ckpt"))
    high_water.start_high_water(spark, pages, out, marks, late, ckpt).awaitTermination()
    return spark.read.parquet(out).drop("batch")


def q_stream_dedup(spark, sf):
    """Overlapping polls de-duplicated over four triggers: the stream's rows alone."""
    pages = scratch_path(spark, "pages")
    live_stream.land_pages(live.pages_from_records(fixtures.load_comments(spark, sf, with_arrival=True)), pages)
    out = scratch_path(spark, "dedup")
    q = live_stream.start_dedup(spark, pages, out, scratch_path(spark, "dedup-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out)


# ---- sinks -----------------------------------------------------------------------

def q_upsert(spark, sf):
    """firstpost keyed by (author, created_utc), written twice: even and odd
    comments, then the last third again.  The last write per key wins."""
    rows = _comments(spark, sf).select(*history.POST_COLUMNS, base36_to_long("id").alias("code"))
    path = scratch_path(spark, "firstpost")
    for part in (F.col("code") % 2 == 0, (F.col("code") % 2 == 1) | (F.col("code") % 3 == 0)):
        sink.upsert_table(rows.filter(part), path, ["author", "created_utc"], [F.col("code")])
    return spark.read.parquet(path).select(*history.POST_COLUMNS)


def q_ttl(spark, sf):
    """Per-minute subreddit counts still alive at the newest arrival."""
    recs = live.good_records(live.parse_messages(_messages(spark, sf)))
    counts = live.slot_counts(recs, "subreddit", "arrived_at", with_start=True)
    as_of = F.lit(_newest(spark, sf, MINUTE_RATE))
    return live.retained(counts, "slot_start", as_of, live.TREND_TTL_SECONDS).drop("slot_start")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}

"""Live comment feed, per-slot top subreddits / authors, and poll de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from threadlens.functions.timefmt import day_label, day_number, epoch_seconds, minute_slot, slot_start
from threadlens.operators import live
from threadlens.operators.sink import (compact_days, file_number, keep_number, kept_number, overwrite_partitions,
                                       partitions_of, read_compacted)
from threadlens.sources.schema import FEED_PAGE_SCHEMA

RECORD_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("value", T.StringType()),
])
#: What names a message: an offset alone is unique within its partition only.
MESSAGE_ID = ("topic", "partition", "offset")


# ---- sources ---------------------------------------------------------------

def as_records(messages: DataFrame, topic: str = "comments", offset: str = "offset",
               timestamp: str = "arrived_at", partitions: int = 1) -> DataFrame:
    """Messages in the shape a Kafka source yields them."""
    at = F.col(offset).cast("bigint")
    return messages.select(F.lit(topic).alias("topic"), F.pmod(at, F.lit(partitions)).cast("int").alias("partition"),
                           at.alias("offset"), F.col(timestamp).cast("bigint").alias("timestamp"),
                           F.col("value").cast("string").alias("value"))


#: Messages for which a landed chunk gets one more file, and the name that keeps the number of files.
FILE_ROWS, FILES = 250_000, "_files"


def _spread(rows: DataFrame, files: int) -> DataFrame:
    """``rows`` in ``files`` partitions of about as many rows, in offset order.
    The cuts come from the offsets alone: a range partitioning would build
    every message once more to sample them."""
    if files == 1:
        return rows.repartition(1)
    cuts = rows.agg(F.percentile_approx("offset", [n / files for n in range(1, files)])).first()[0] or []
    number = sum(((F.col("offset") > F.lit(c)).cast("int") for c in cuts), F.lit(0))
    return rows.repartitionById(files, number)


def land_records(messages: DataFrame, path: str, chunks: int = 4, files: int | None = None, mode: str = "errorifexists",
                 newest_first: bool = False, file_rows: int = FILE_ROWS, **names) -> None:
    """Write a topic's messages as Parquet files that a file stream replays in
    offset order: ``chunks`` ranges of the offsets are landed one after the
    other (a file source reads older files first), each as ``files`` files,
    by default one for every ``file_rows`` messages of a mean chunk, so that no
    task writes or reads a whole chunk of a large topic.

    Every chunk of a path has as many files as the first one, which is kept
    with the path (``file_source`` reads whole chunks by it); where a range is
    empty, an empty file stands for it."""
    spark, rows = messages.sparkSession, as_records(messages, **names)
    lo, hi, size = rows.agg(F.min("offset"), F.max("offset"), F.count("offset")).first()
    lo, hi = (lo, hi) if lo is not None else (0, 0)
    step = -(-(hi - lo + 1) // chunks)
    kept = kept_number(spark, path, FILES) or (1 if file_number(spark, path) else None)
    files = kept or files or max(1, -(-size // (chunks * file_rows)))
    for n in sorted(range(chunks), reverse=newest_first):
        part = rows.filter(F.col("offset").between(lo + n * step, lo + (n + 1) * step - 1))
        there = file_number(spark, path)
        _spread(part, files).sortWithinPartitions("offset").write.mode(mode).parquet(path)
        mode = "append"
        for _ in range(there + files - file_number(spark, path)):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode(mode).parquet(path)
    if files > 1:
        keep_number(spark, path, FILES, files)


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Landed records as a stream, by default one landed chunk (one file, unless
    ``land_records`` made several of each) in each trigger."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger * (kept_number(spark, path, FILES) or 1))
    return reader.parquet(path)


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                 starting_timestamp: int | None = None) -> DataFrame:
    """Kafka topic as records.  Needs the spark-sql-kafka connector on the
    classpath (not bundled here).  ``starting_timestamp`` (epoch ms) restarts
    from a point in time, e.g. to skip ahead after lag."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if starting_timestamp is not None:
        reader = reader.option("startingTimestamp", str(starting_timestamp))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(*MESSAGE_ID, epoch_seconds("timestamp").alias("timestamp"),
                                F.col("value").cast("string").alias("value"))


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a batch of messages (column ``value``) to a Kafka topic; needs the
    connector as well."""
    (messages.select(F.col("value").cast("string").alias("value")).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


#: State-store partitions of a stream that names no number of its own.
STATE_PARTITIONS = 8
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB (off-heap, spills to local disk and is
    snapshotted to the checkpoint) instead of executor heap: the choice for
    state that grows with the number of keys per window."""
    spark.conf.set(STATE_PROVIDER, ROCKSDB_PROVIDER)


def _start(df_writer, checkpoint: str, available_now: bool, processing_time: str | None,
           spark: SparkSession | None = None, state_partitions: int | None = None, rocksdb: bool = False):
    """Start a query.  For a stateful query, ``state_partitions`` fixes the
    number of state-store partitions: Spark records it in the checkpoint at
    the first start and keeps it on every restart, so a job sets it for the
    keys it expects.  The default is ``STATE_PARTITIONS``; the session setting is restored right after start
    (the stream runs on its own clone of the session).  ``rocksdb`` names the
    state store that timers and state TTL need."""
    w = df_writer.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if spark is None:
        return w.start()
    want = {SHUFFLE_PARTITIONS: str(state_partitions or STATE_PARTITIONS)}
    if rocksdb:
        want[STATE_PROVIDER] = ROCKSDB_PROVIDER
    old = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        return w.start()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ---- feed: parse, dead letters, per-second feed table ---------------------

def start_feed(records: DataFrame, feed_path: str, dead_path: str, checkpoint: str,
               available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Parse each micro-batch once and fan it out to two sinks: the feed table
    (arrival second, subreddit, author, created_utc, body) and the dead-letter
    table.  Output partitions are (day, batch): a replayed batch overwrites
    exactly its own folders."""
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = live.parse_messages(batch.withColumnRenamed("timestamp", "arrived_at"))
        parsed.persist()
        try:
            feed = (live.feed_rows(live.good_records(parsed))
                    .withColumn("day", day_number("secslot")).withColumn("batch", F.lit(batch_id)))
            # Feed volume per day is unbounded: range-partition on (day, second)
            # so a busy day spans several writers and each file covers a
            # narrow time range (min/max statistics prune slot reads).
            feed = feed.repartitionByRange("day", "secslot").sortWithinPartitions("day", "secslot")
            overwrite_partitions(feed, feed_path, ["day", "batch"])
            dead = live.dead_letters(parsed, keep=(*MESSAGE_ID, "arrived_at"))
            overwrite_partitions(dead.withColumn("batch", F.lit(batch_id)), dead_path, ["batch"])
        finally:
            parsed.unpersist()
    return _start(records.writeStream.foreachBatch(write), checkpoint, available_now, processing_time)


# ---- per-slot top lists ----------------------------------------------------

def slot_trend_counts(records: DataFrame, key: str, time_col: str = "arrived_at",
                      slot_seconds: int = 60, delay: str = "2 minutes") -> DataFrame:
    """Streaming counts per (tumbling slot, key) with a watermark; state for a
    slot is dropped once the watermark passes its end.  Slots follow arrival,
    as the live counter's ticks do: arrival only moves forward in offset
    order, so a topic read in order has no late rows.  ``time_col`` may name
    the comment's own time instead, at the price of late rows."""
    good = live.good_records(live.parse_messages(records.withColumnRenamed("timestamp", "arrived_at")))
    timed = (good.dropna(subset=["author", "subreddit"])
             .withColumn("event_time", F.timestamp_seconds(time_col))
             .withWatermark("event_time", delay))
    return (timed.groupBy(F.window("event_time", f"{slot_seconds} seconds").alias("w"), F.col(key))
            .agg(F.count(F.lit(1)).cast("int").alias("count"))
            .select(F.unix_seconds(F.col("w.start")).alias("slot_start"),
                    minute_slot(F.unix_seconds(F.col("w.start"))).alias("minuteslot"), key, "count"))


def trend_rows(counts: DataFrame, key: str, k: int = live.TOP_K) -> DataFrame:
    """Stored form of slot counts: the top ``k`` keys of each slot, with the
    slot's total over *all* keys, its start and its day."""
    totals = counts.groupBy("minuteslot").agg(F.sum("count").alias("slot_total"))
    return live.top_per_slot(counts, key, k).join(totals, "minuteslot") \
        .withColumn("day", day_number("slot_start"))


def start_slot_trends(records: DataFrame, key: str, sink_path: str, checkpoint: str,
                      time_col: str = "arrived_at", slot_seconds: int = 60, k: int = live.TOP_K,
                      delay: str = "2 minutes", available_now: bool = True,
                      processing_time: str | None = None,
                      state_partitions: int | None = None) -> StreamingQuery:
    """Top ``k`` keys of every closed slot.

    Append mode emits a slot once, in the batch whose watermark closes it, so
    ranking inside ``foreachBatch`` sees the whole slot (a row_number window is
    not allowed on the stream itself).  Writes are partitioned by (day, batch)
    and overwrite on replay, which makes the sink exactly-once.  Rows that a
    watermark drops as late are found and put back by ``slot_shortfall`` and
    ``repair_slots``.
    """
    counts = slot_trend_counts(records, key, time_col, slot_seconds, delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            # A day of a top-k table holds at most k rows per slot, so clustering a
            # day into one writer task is bounded; it keeps one file per day.
            out = (trend_rows(batch, key, k).withColumn("batch", F.lit(batch_id))
                   .repartition("day").sortWithinPartitions("minuteslot", "rank"))
            overwrite_partitions(out, sink_path, ["day", "batch"])
        finally:
            batch.unpersist()
    return _start(counts.writeStream.outputMode("append").foreachBatch(write),
                  checkpoint, available_now, processing_time, records.sparkSession, state_partitions)


def trend_schema(key: str) -> str:
    """Columns of a stored trend table, without day and batch."""
    return f"minuteslot long, slot_start long, {key} string, count int, rank long, slot_total long"


def _since(archive: DataFrame, since: int | None) -> DataFrame:
    """Archived records of slots that may start at ``since`` or later; the day
    folders before it are not read."""
    if since is None:
        return archive
    rows = archive.filter(F.col("arrived_at") >= since)
    return rows.filter(F.col("day") >= day_label(since)) if "day" in archive.columns else rows


def slot_shortfall(archive: DataFrame, trends: DataFrame, key: str, until: int, slot_seconds: int = 60,
                   since: int | None = None) -> DataFrame:
    """(day, minuteslot, archived, counted, missing) of the slots that ended by
    ``until`` and whose stored total lacks archived comments: what the
    watermark dropped as late.  ``archive`` has every record once.  Slots that
    started before ``since`` (epoch seconds) are left alone: what has expired
    is not missing."""
    counts = live.slot_counts(_since(archive, since), key, "arrived_at", slot_seconds, with_start=True) \
        .filter((F.col("slot_start") + slot_seconds <= until) & (F.col("slot_start") >= (since or 0)))
    true = counts.groupBy("slot_start", "minuteslot").agg(F.sum("count").alias("archived"))
    stored = trends.select("minuteslot", "slot_total").distinct().groupBy("minuteslot") \
        .agg(F.max("slot_total").alias("counted"))
    return (true.join(stored, "minuteslot", "left")
            .select(day_number("slot_start").alias("day"), "minuteslot", "archived",
                    F.coalesce("counted", F.lit(0)).alias("counted"))
            .withColumn("missing", F.col("archived") - F.col("counted")).filter("missing <> 0"))


def repair_slots(spark: SparkSession, archive: DataFrame, trend_path: str, compact_path: str, key: str, until: int,
                 slot_seconds: int = 60, k: int = live.TOP_K, since: int | None = None) -> list[int]:
    """Rebuild the top lists of slots with a shortfall from the archive and
    store their days compacted; returns those days.  Days without a shortfall
    are not touched, nor are slots before ``since``."""
    alive = _since(archive, since)
    days = None if since is None else sorted({
        d for path in (trend_path, compact_path) for (d,) in partitions_of(spark, path, "day") if d >= day_label(since)})
    stored = read_compacted(spark, trend_path, compact_path, days, trend_schema(key))
    short = slot_shortfall(alive, stored, key, until, slot_seconds, since)
    days = sorted(r["day"] for r in short.select("day").distinct().collect())  # one number per day
    if not days:
        return []
    compact_days(spark, trend_path, compact_path, days, ["minuteslot", "rank"])
    through = dict(partitions_of(spark, compact_path, "day", "through"))
    old = read_compacted(spark, trend_path, compact_path, days, trend_schema(key))
    again = alive.filter(day_number(slot_start("arrived_at", slot_seconds)).isin(days))
    fresh = trend_rows(live.slot_counts(again, key, "arrived_at", slot_seconds, with_start=True)
                       .filter((F.col("slot_start") + slot_seconds <= until)
                               & (F.col("slot_start") >= (since or 0))), key, k)
    slots = fresh.select("minuteslot").distinct()
    rows = old.join(slots, "minuteslot", "left_anti").unionByName(fresh)
    number = F.element_at(F.create_map(*[F.lit(x) for d in days for x in (d, through.get(d, -1))]),
                          F.col("day").cast("int"))
    overwrite_partitions(rows.withColumn("through", number).sortWithinPartitions("day", "minuteslot", "rank"),
                         compact_path, ["day", "through"])
    return days


def read_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


# ---- overlapping polls ------------------------------------------------------

def land_pages(pages: DataFrame, path: str, chunks: int = 4) -> None:
    """Listing pages as files in poll order, ``chunks`` one after the other."""
    lo, hi = pages.agg(F.min("page"), F.max("page")).first()
    lo, hi = (lo, hi) if lo is not None else (0, 0)
    step = -(-(hi - lo + 1) // chunks)
    for n in range(chunks):
        (pages.filter(F.col("page").between(lo + n * step, lo + (n + 1) * step - 1))
         .coalesce(1).write.mode("append").parquet(path))


def start_dedup(spark: SparkSession, pages_path: str, sink_path: str, checkpoint: str,
                delay: str = "10 minutes", available_now: bool = True,
                processing_time: str | None = None, state_partitions: int | None = None,
                max_files_per_trigger: int | None = 1) -> StreamingQuery:
    """Flatten landed listing pages and drop comments already seen, keyed by id,
    with state bounded by the watermark (``dropDuplicatesWithinWatermark``).

    A repeat comes from an overlapping later poll, so the watermark runs on the
    poll time (monotone in arrival order) and ``delay`` must cover the interval
    between polls; a comment created long before it is polled is therefore
    never mistaken for late data.  A page that itself arrives after ``delay``
    is dropped; ``live.unseen_comments`` finds what it held.  The file sink
    commits through its own log: exactly once."""
    reader = spark.readStream.schema(FEED_PAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.parquet(pages_path)
    rows = (live.flatten_pages(pages)
            .withColumn("poll_time", F.timestamp_seconds("polled_at"))
            .withWatermark("poll_time", delay)
            .dropDuplicatesWithinWatermark(["id"])
            .drop("page", "polled_at", "poll_time"))
    w = rows.writeStream.format("parquet").option("path", sink_path).outputMode("append")
    return _start(w, checkpoint, available_now, processing_time, spark, state_partitions)


# ---- rolling JSON archive -----------------------------------------------------

def start_archive(records: DataFrame, path: str, checkpoint: str, max_records_per_file: int = 1_000_000,
                  available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Archive parsed comments as JSON lines, one folder per arrival day; files
    are as large as a batch, a new one only past ``max_records_per_file`` rows.
    The file sink's commit log makes the archive exactly-once across restarts."""
    good = live.good_records(live.parse_messages(records.withColumnRenamed("timestamp", "arrived_at")))
    rows = good.withColumn("day", day_number("arrived_at"))
    w = (rows.writeStream.format("json").option("path", path).partitionBy("day")
         .option("maxRecordsPerFile", max_records_per_file).outputMode("append"))
    return _start(w, checkpoint, available_now, processing_time)

"""Stream = batch parity on closed windows, dedup, feed fan-out."""

from pyspark.sql import functions as F

from conftest import SF001
from threadlens.operators import live
from threadlens.plans import queries as Q
from threadlens.session import scratch_path
from threadlens.sources import fixtures
from threadlens.streaming import live_stream


def _batch_closed(spark, key, slot_seconds, rate, delay):
    recs = live.good_records(live.parse_messages(Q._messages(spark, SF001, rate)))
    newest = recs.agg(F.max("arrived_at")).first()[0]
    counts = live.slot_counts(recs, key, "arrived_at", slot_seconds, with_start=True)
    closed = counts.filter(F.col("slot_start") + slot_seconds <= newest - delay).drop("slot_start")
    return live.top_per_slot(closed, key)


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_trends_equal_batch_on_closed_windows(spark):
    for key, slot, rate, delay in (("subreddit", 60, Q.MINUTE_RATE, 5), ("author", 3600, Q.HOUR_RATE, 120)):
        stream = Q._stream_trends(spark, SF001, key, slot, rate, delay)
        cols = ["minuteslot", key, "count", "rank"]
        rows = _rows(stream, cols)
        assert rows == _rows(_batch_closed(spark, key, slot, rate, delay), cols) and rows


def test_a_topic_in_order_loses_nothing_over_several_triggers(spark):
    """Four triggers or one: the same slots, and no archived comment missing."""
    src = Q._landed_records(spark, SF001, rate=Q.HOUR_RATE)
    outs = []
    for per_trigger in (None, 1):
        out, ckpt = scratch_path(spark, "t"), scratch_path(spark, "c")
        q = live_stream.start_slot_trends(
            live_stream.file_source(spark, src, max_files_per_trigger=per_trigger), "subreddit", out, ckpt,
            slot_seconds=3600, delay="2 minutes")
        q.awaitTermination()
        batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
        assert len(batches) == (4 if per_trigger else 1)
        outs.append(_rows(spark.read.parquet(out), ["minuteslot", "subreddit", "count", "rank"]))
        short = live_stream.slot_shortfall(Q._records(spark, SF001, Q.HOUR_RATE), spark.read.parquet(out), "subreddit",
                                           Q._newest(spark, SF001, Q.HOUR_RATE) - 120, 3600)
        assert short.isEmpty()
    assert outs[0] == outs[1] and len(outs[0]) > 0


def test_counted_plus_reported_late_equals_the_input(spark):
    """Chunks landed newest first: the watermark drops rows, the report names
    every one of them, and the repair puts them back."""
    from threadlens.operators import sink
    rate, slot = Q.HOUR_RATE, 3600
    out = Q._trend_table(spark, SF001, "subreddit", slot, rate, 120, newest_first=True)
    archive, until = Q._records(spark, SF001, rate), Q._newest(spark, SF001, rate) - 120
    stored = spark.read.parquet(out)
    short = live_stream.slot_shortfall(archive, stored, "subreddit", until, slot)
    late = short.agg(F.sum("missing")).first()[0]
    counted = stored.select("minuteslot", "slot_total").distinct().agg(F.sum("slot_total")).first()[0] or 0
    whole = live.slot_counts(archive, "subreddit", "arrived_at", slot, with_start=True) \
        .filter(F.col("slot_start") + slot <= until).agg(F.sum("count")).first()[0]
    assert late > 0 and counted + late == whole
    compact = scratch_path(spark, "compact")
    assert live_stream.repair_slots(spark, archive, out, compact, "subreddit", until, slot)
    cols = ["minuteslot", "subreddit", "count", "rank"]
    assert _rows(sink.read_compacted(spark, out, compact), cols) == \
        _rows(_batch_closed(spark, "subreddit", slot, rate, 120), cols)
    assert not live_stream.repair_slots(spark, archive, out, compact, "subreddit", until, slot)


def test_stream_restart_is_idempotent(spark):
    """Re-running a finished query from its checkpoint adds nothing."""
    src = Q._landed_records(spark, SF001)
    out, ckpt = scratch_path(spark, "t"), scratch_path(spark, "c")
    for _ in range(2):
        q = live_stream.start_slot_trends(live_stream.file_source(spark, src), "author", out, ckpt,
                                          delay="5 seconds")
        q.awaitTermination()
    df = spark.read.parquet(out)
    assert df.count() == df.select("minuteslot", "author").distinct().count()


def test_dedup_stream_equals_distinct_comments(spark):
    got = Q.q_stream_dedup(spark, SF001)
    want = fixtures.load_comments(spark, SF001)
    assert got.count() == want.count() == got.select("id").distinct().count()


def test_feed_stream_fans_out_dead_letters(spark):
    src = Q._landed_records(spark, SF001, junk=True)
    feed, dead = scratch_path(spark, "feed"), scratch_path(spark, "dead")
    q = live_stream.start_feed(live_stream.file_source(spark, src), feed, dead, scratch_path(spark, "ck"))
    q.awaitTermination()
    n_dead = spark.read.parquet(dead).count()
    n_feed = spark.read.parquet(feed).count()
    total = fixtures.load_comments(spark, SF001).count()
    expect_dead = total // Q.DEAD_LETTER_EVERY + 1
    assert n_dead == expect_dead and n_feed + n_dead == total


def test_rocksdb_state_store_gives_same_trends(spark):
    src = Q._landed_records(spark, SF001)
    outs = []
    old = spark.conf.get(live_stream.STATE_PROVIDER, None)
    try:
        for rocks in (False, True):
            if rocks:
                live_stream.use_rocksdb_state(spark)
            out, ckpt = scratch_path(spark, "t"), scratch_path(spark, "c")
            q = live_stream.start_slot_trends(live_stream.file_source(spark, src), "author", out, ckpt,
                                          delay="5 seconds")
            q.awaitTermination()
            outs.append(_rows(spark.read.parquet(out), ["minuteslot", "author", "count", "rank"]))
    finally:
        if old is None:
            spark.conf.unset(live_stream.STATE_PROVIDER)
        else:
            spark.conf.set(live_stream.STATE_PROVIDER, old)
    assert outs[0] == outs[1] and outs[0]


def test_dedup_across_batches_with_out_of_order_creation(spark):
    """Pages landed in poll order, one file per trigger: repeats of the
    previous page are dropped, and comments whose creation time lies far
    before others (shifted threads) are kept."""
    pages = live.pages_from_records(fixtures.load_comments(spark, SF001, with_arrival=True))
    src = scratch_path(spark, "pages-seq")
    for lo in range(0, 11, 3):
        pages.filter((F.col("page") >= lo) & (F.col("page") < lo + 3)).coalesce(1) \
            .write.mode("append").parquet(src)
    out = scratch_path(spark, "dedup-seq")
    # a page of the sf0.001 fixture spans a few days of arrivals
    q = live_stream.start_dedup(spark, src, out, scratch_path(spark, "ck"), delay="30 days",
                                max_files_per_trigger=1)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4
    got = spark.read.parquet(out)
    assert got.count() == got.select("id").distinct().count() == 1000


def test_late_pages_are_found(spark):
    """Pages landed newest first: what the watermark drops, ``unseen_comments``
    names."""
    from threadlens.sources.schema import FEED_PAGE_SCHEMA
    pages = live.pages_from_records(fixtures.load_comments(spark, SF001, with_arrival=True))
    src = scratch_path(spark, "pages-late")
    for lo in (6, 3, 0, 9):
        pages.filter((F.col("page") >= lo) & (F.col("page") < lo + 3)).coalesce(1).write.mode("append").parquet(src)
    out = scratch_path(spark, "dedup-late")
    live_stream.start_dedup(spark, src, out, scratch_path(spark, "ck"), delay="1 second").awaitTermination()
    seen = spark.read.parquet(out)
    lost = live.unseen_comments(live.flatten_pages(spark.read.schema(FEED_PAGE_SCHEMA).parquet(src)), seen)
    assert lost.count() > 0 and lost.count() + seen.count() == 1000


def test_compaction_hides_no_row(spark):
    """Compact some days, append a late batch to a compacted day, compact
    again, expire: every living row is read exactly once, with pruned folders."""
    from threadlens.operators import sink
    from threadlens.plans.inspect import explain_string
    raw, compact = scratch_path(spark, "raw"), scratch_path(spark, "compact")
    rows = [(d, b, n) for d in (20240101, 20240102, 20240103) for b in (0, 1) for n in range(5)]
    schema = "day bigint, batch bigint, n bigint"

    def put(items):
        sink.overwrite_partitions(spark.createDataFrame(items, schema), raw, ["day", "batch"])

    def read(days=None):
        return sorted((r.day, r.n) for r in sink.read_compacted(spark, raw, compact, days).collect())
    put(rows)
    assert read() == sorted((d, n) for d, _, n in rows)
    for _ in range(2):
        sink.compact_days(spark, raw, compact, [20240101, 20240103, 20231231], ["n"])
    assert read() == sorted((d, n) for d, _, n in rows)
    late = [(20240101, 2, 77), (20240102, 2, 78)]
    put(late)
    assert read() == sorted((d, n) for d, _, n in rows + late)
    sink.compact_days(spark, raw, compact, [20240101], ["n"])
    assert read() == sorted((d, n) for d, _, n in rows + late)
    assert read([20240102]) == sorted((d, n) for d, _, n in rows + late if d == 20240102)
    filters = [ln for ln in explain_string(sink.read_compacted(spark, raw, compact, [20240101])).splitlines()
               if "PartitionFilters" in ln]
    assert filters and all("day" in ln for ln in filters)
    assert sink.expire_days(spark, [raw, compact], 20240102) == [20240101]
    assert read() == sorted((d, n) for d, _, n in rows + late if d > 20240101)


def test_upsert_touches_only_its_buckets(spark):
    from threadlens.operators import sink
    path = scratch_path(spark, "kv")
    old = [(f"k{i}", 1, "old") for i in range(100)]
    sink.upsert_table(spark.createDataFrame(old, "k string, v int, x string"), path, ["k"], [F.col("v")], buckets=16)
    before = dict(spark.read.parquet(path).withColumn("f", F.input_file_name()).select("bucket", "f").distinct().collect())
    new = [("k1", 2, "new"), ("k2", 0, "stale"), ("z", 5, "added")]
    sink.upsert_table(spark.createDataFrame(new, "k string, v int, x string"), path, ["k"], [F.col("v")], buckets=16)
    table = {r.k: r.x for r in spark.read.parquet(path).collect()}
    assert len(table) == 101 and (table["k1"], table["k2"], table["z"]) == ("new", "old", "added")
    after = dict(spark.read.parquet(path).withColumn("f", F.input_file_name()).select("bucket", "f").distinct().collect())
    assert sum(after[b] != f for b, f in before.items()) <= 3


def test_chunks_of_several_files_are_replayed_whole_and_in_order(spark):
    """A topic whose chunks take several files, with gaps that leave ranges
    empty: one chunk a trigger, nothing late, and as many files in each chunk."""
    from threadlens.operators import sink
    rate, slot = Q.HOUR_RATE, 3600
    messages = Q._messages(spark, SF001, rate)
    gaps = messages.filter("offset < 251 or offset > 499")
    for rows, path in ((messages, scratch_path(spark, "many")), (gaps, scratch_path(spark, "gaps"))):
        live_stream.land_records(rows, path, file_rows=60)
        files = sink.kept_number(spark, path, live_stream.FILES)
        assert files > 2 and sink.file_number(spark, path) == 4 * files
        assert spark.read.parquet(path).count() == rows.count()
        by_task = spark.read.parquet(path).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        assert by_task < 250
        out = scratch_path(spark, "t")
        q = live_stream.start_slot_trends(live_stream.file_source(spark, path), "subreddit", out,
                                          scratch_path(spark, "c"), slot_seconds=slot, delay="2 minutes")
        q.awaitTermination()
        batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
        assert sum(batches) == rows.count() and len(batches) == 4
        counts = live.slot_counts(live.good_records(live.parse_messages(rows)), "subreddit", "arrived_at", slot,
                                  with_start=True)
        newest = rows.agg(F.max("arrived_at")).first()[0]
        closed = counts.filter(F.col("slot_start") + slot <= newest - 120).drop("slot_start")
        cols = ["minuteslot", "subreddit", "count", "rank"]
        assert _rows(spark.read.parquet(out), cols) == _rows(live.top_per_slot(closed, "subreddit"), cols)
    live_stream.land_records(messages, path, chunks=2, mode="append")
    assert sink.file_number(spark, path) == 6 * files

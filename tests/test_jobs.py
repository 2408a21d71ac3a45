"""Cluster jobs end to end on a landed JSON dump (sf0.001)."""

from pyspark.sql import functions as F

from conftest import SF001
from threadlens import jobs
from threadlens.operators import graph, recommend, snapshot
from threadlens.session import scratch_path
from threadlens.sources import fixtures, json_source
from threadlens.sources.schema import COMMENT_COLUMNS, RAW_COMMENT_SCHEMA


def _land_dump(spark, month_files=2):
    """The fixture as raw JSON dump files with one broken line."""
    root = scratch_path(spark, "dump")
    c = fixtures.load_comments(spark, SF001).withColumn("created_utc", F.col("created_utc").cast("string"))
    c.select(*RAW_COMMENT_SCHEMA.fieldNames()).repartition(month_files).write.json(f"{root}/RC_2024-01")
    spark.createDataFrame([("{broken",)], "value string").write.text(f"{root}/RC_bad")
    return root


def test_ingest_then_batch_jobs(spark):
    dump = _land_dump(spark)
    out = scratch_path(spark, "warehouse")
    jobs.ingest_job(spark, f"{dump}/*", f"{out}/comments", f"{out}/dead")
    comments = json_source.read_comments_parquet(spark, f"{out}/comments")
    want = fixtures.load_comments(spark, SF001)
    assert comments.select(*COMMENT_COLUMNS).exceptAll(want).count() == 0
    assert comments.count() == want.count()
    assert spark.read.json(f"{out}/dead").count() == 1

    jobs.flashback_job(spark, f"{out}/comments", out)
    assert spark.read.parquet(f"{out}/firstpost").count() == want.count()

    jobs.snapshot_job(spark, f"{out}/comments", out)
    got = spark.read.parquet(f"{out}/subredditinfo")
    expect = snapshot.top_subreddits_per_month(snapshot.monthly_stats(want), 100)
    assert got.select(*expect.columns).exceptAll(expect).count() == 0

    jobs.graph_job(spark, f"{out}/comments", out)
    degs = jobs.current_degrees(spark, out)
    edges = spark.read.parquet(f"{out}/edges")
    assert degs.filter("kind = 'indegree'").agg(F.sum("rank")).first()[0] == edges.count()
    assert spark.read.parquet(f"{out}/engagement").count() == \
        graph.engagement(graph.reply_edges(want)).count()

    jobs.recommend_job(spark, f"{out}/comments", f"{out}/edges", out)
    recs = spark.read.parquet(f"{out}/recommendations")
    expect = recommend.graph_recommend(want, graph.reply_edges(want))
    assert recs.exceptAll(expect).count() == 0 and expect.exceptAll(recs).count() == 0


def test_source_file_is_the_dump_name(spark):
    dump = _land_dump(spark, month_files=1)
    raw = json_source.read_raw_comments(spark, f"{dump}/RC_2024-01", with_source=True)
    assert {r.source_file for r in raw.select("source_file").distinct().collect()} == {"RC_2024-01"}
    names = spark.createDataFrame([("s3://b/dumps/RC_2024-02.json.gz",), ("hdfs://n/x/RC_2024-03/part-0001.json",)], "p string")
    assert [r[0] for r in names.select(json_source.table_name_of("p")).collect()] == ["RC_2024-02", "RC_2024-03"]


def test_month_by_month_ingest_replaces_a_month(spark):
    dump = _land_dump(spark)
    out = scratch_path(spark, "months")
    for _ in range(2):
        json_source.ingest(spark, f"{dump}/*", f"{out}/c", f"{out}/dead", mode="replace")
    assert json_source.read_comments_parquet(spark, f"{out}/c").count() == fixtures.load_comments(spark, SF001).count()
    dead = spark.read.json(f"{out}/dead").collect()
    assert [(r.line, r.source_file) for r in dead] == [("{broken", "RC_bad")]


def test_scale_conf_sizes_partitions():
    from threadlens.session import scale_conf
    small = scale_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = scale_conf(100 * (1 << 40), 8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * (1 << 40) // (256 << 20))
    mid = scale_conf(1 << 40, 1000)
    assert mid["spark.sql.shuffle.partitions"] == str((1 << 40) // (256 << 20))


def test_snapshot_month_job_replaces_only_its_month(spark):
    out = scratch_path(spark, "wh")
    comments = fixtures.load_comments(spark, SF001)
    json_source.write_comments_parquet(comments, f"{out}/comments")
    jobs.snapshot_job(spark, f"{out}/comments", out)
    before = spark.read.parquet(f"{out}/subredditinfo").collect()
    jobs.snapshot_month_job(spark, f"{out}/comments", out, 2024, 7)
    after = spark.read.parquet(f"{out}/subredditinfo").collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))


def test_live_job_on_landed_records(spark):
    from threadlens.plans import queries as Q
    from threadlens.streaming import live_stream
    src = Q._landed_records(spark, SF001, junk=True, rate=(1, 1))
    out, ck = scratch_path(spark, "live"), scratch_path(spark, "live-ck")
    old = spark.conf.get(live_stream.STATE_PROVIDER, None)
    try:
        jobs.live_job(spark, lambda: live_stream.file_source(spark, src), out, ck, available_now=True)
    finally:
        if old is None:
            spark.conf.unset(live_stream.STATE_PROVIDER)
        else:
            spark.conf.set(live_stream.STATE_PROVIDER, old)
    total = fixtures.load_comments(spark, SF001).count()
    dead = spark.read.parquet(f"{out}/dead_letters").count()
    assert spark.read.parquet(f"{out}/feed").count() + dead == total
    assert spark.read.json(f"{out}/archive").count() == total - dead
    assert spark.read.parquet(f"{out}/top_subreddits").count() > 0
    assert spark.read.parquet(f"{out}/top_authors").count() > 0


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_graph_months_in_any_order_with_reruns(spark):
    """A full build over two months, the third added, an old month added again,
    and a month replaced by fewer rows: always the graph of what is stored."""
    out = scratch_path(spark, "wh-inc")
    c = json_source.with_month(fixtures.load_comments(spark, SF001))
    months = sorted((r[0], r[1]) for r in c.select("year", "month").distinct().collect())
    assert len(months) == 3
    store = f"{out}/comments"

    def put(year, month, rows=c):
        part = rows.filter((F.col("year") == year) & (F.col("month") == month)).select(*COMMENT_COLUMNS)
        json_source.write_comments_parquet(part, store, mode="replace")

    def check():
        stored = json_source.read_comments_parquet(spark, store)
        want = graph.reply_edges(stored)
        assert _same(spark.read.parquet(f"{out}/edges").select(*want.columns), want)
        degs = graph.all_degrees(want)
        assert _same(jobs.current_degrees(spark, out).select(*degs.columns), degs)
        leaders = graph.engagement(want)
        assert _same(spark.read.parquet(f"{out}/engagement").select(*leaders.columns), leaders)
    put(*months[0])
    put(*months[2])
    jobs.graph_job(spark, store, out)
    check()
    put(*months[1])
    jobs.graph_increment_job(spark, store, out, *months[1])
    check()
    jobs.graph_increment_job(spark, store, out, *months[0])
    check()
    put(*months[1], rows=c.filter("id < 'd'"))
    jobs.graph_increment_job(spark, store, out, *months[1])
    check()


def test_live_upkeep(spark):
    """Streams over a topic landed newest first lose late rows; upkeep puts them
    back from the archive, compacts closed days and drops expired ones."""
    from threadlens.operators import live, sink
    from threadlens.plans import queries as Q
    from threadlens.streaming import live_stream
    rate = (1, 120)  # 1,000 messages over a day and a half
    src = Q._landed_records(spark, SF001, rate=rate, newest_first=True)
    out, ck = scratch_path(spark, "live"), scratch_path(spark, "live-ck")
    old = spark.conf.get(live_stream.STATE_PROVIDER, None)
    try:
        jobs.live_job(spark, lambda: live_stream.file_source(spark, src), out, ck, slot_seconds=3600, available_now=True)
    finally:
        spark.conf.unset(live_stream.STATE_PROVIDER) if old is None else spark.conf.set(live_stream.STATE_PROVIDER, old)
    newest = Q._newest(spark, SF001, rate)
    archive = spark.read.schema(jobs.ARCHIVE_SCHEMA).json(f"{out}/archive")
    raw = spark.read.parquet(f"{out}/top_authors")
    short = live_stream.slot_shortfall(archive, raw, "author", newest - 120, 3600)
    lost = short.agg(F.sum("missing")).first()[0]
    total = live.slot_counts(archive, "author", "arrived_at", 3600, with_start=True) \
        .filter(F.col("slot_start") + 3600 <= newest - 120).agg(F.sum("count")).first()[0]
    counted = raw.select("minuteslot", "slot_total").distinct().agg(F.sum("slot_total")).first()[0] or 0
    assert lost > 0 and counted + lost == total
    done = jobs.maintain_live_job(spark, out, newest, slot_seconds=3600, trend_ttl=10**6, feed_ttl=300)
    assert done["repaired top_authors"] and done["expired feed"]
    table = sink.read_compacted(spark, f"{out}/top_authors", f"{out}/top_authors_compacted")
    want = live.minute_trends(archive, "author", slot_seconds=3600)
    got = table.select("minuteslot", "author", "count", "rank")
    closed = want.join(table.select("minuteslot").distinct(), "minuteslot").select(*got.columns)
    assert _same(got, closed)
    assert live_stream.slot_shortfall(archive, table, "author", newest - 120, 3600).isEmpty()
    again = jobs.maintain_live_job(spark, out, newest, slot_seconds=3600, trend_ttl=10**6, feed_ttl=300)
    assert not again["repaired top_authors"] and not again["expired feed"]


def test_a_failing_query_ends_the_live_job(spark, tmp_path):
    import pytest
    from threadlens.plans import queries as Q
    from threadlens.streaming import live_stream
    src = Q._landed_records(spark, SF001)
    (tmp_path / "feed").write_text("a file where the feed's folder should be")
    with pytest.raises(Exception):
        jobs.live_job(spark, lambda: live_stream.file_source(spark, src), str(tmp_path), scratch_path(spark, "ck"),
                      available_now=True)
    spark.conf.unset(live_stream.STATE_PROVIDER)
    assert not spark.streams.active

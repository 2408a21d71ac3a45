"""Bucketed tables, bloom filters, sketches, dense ids, upkeep and upsert."""

import re

import pytest
from helpers import comment, comments_df
from pyspark.sql import functions as F

from conftest import SF001
from threadlens import jobs
from threadlens.functions.timefmt import day_label
from threadlens.operators import bucketed, graph, live, recommend, sink, sketches
from threadlens.plans import queries as Q
from threadlens.plans.inspect import explain_string
from threadlens.session import scratch_path
from threadlens.streaming import live_stream


def _same(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_reply_join_of_equal_buckets_has_no_exchange(spark, no_broadcast):
    comments, path = Q._comments(spark, SF001), scratch_path(spark, "sides")
    bucketed.store_reply_sides(comments, "sides", path, buckets=6)
    cool = spark.table("sides_parents").join(spark.table("sides_replies"), bucketed.KEY).select(*graph.EDGE_COLUMNS)
    plan = explain_string(cool)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" in explain_string(graph.reply_edges(comments))
    assert _same(bucketed.stored_reply_edges(spark, "sides"), graph.reply_edges(comments))
    bucketed.attach_reply_sides(spark, comments, "again", path, buckets=6)
    again = bucketed.stored_reply_edges(spark, "again")
    assert _same(again, graph.reply_edges(comments)) and explain_string(again).count("Exchange") == plan.count("Exchange") + \
        explain_string(spark.table("again_parents").join(spark.table("again_hot"), bucketed.KEY)).count("Exchange")


def test_replies_to_a_hot_parent_leave_the_buckets(spark):
    rows = [comment("p", "a"), comment("q", "b")] + [comment(f"r{i}", f"u{i}", parent_id="t1_p" if i % 3 else "t1_q")
                                                     for i in range(60)]
    comments = comments_df(spark, rows)
    bucketed.store_reply_sides(comments, "hot", scratch_path(spark, "hot"), buckets=4, hot_rows=30)
    assert {r[0] for r in spark.table("hot_hot").select(bucketed.KEY).distinct().collect()} == {"t1_p"}
    assert spark.table("hot_replies").filter(f"{bucketed.KEY} = 't1_p'").isEmpty()
    assert _same(bucketed.stored_reply_edges(spark, "hot"), graph.reply_edges(comments))


def _scanned(df):
    """Rows that the executed plan's file scan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    inner = [p.executedPlan() if "AdaptiveSparkPlan" in p.nodeName() else p for p in found]
    return sum(p.metrics().apply("numOutputRows").value() for p in inner if "Scan" in p.nodeName())


def test_bloom_filters_rule_out_row_groups(spark):
    """Names spread over all row groups: minimum and maximum rule out none, the
    filter nearly all."""
    rows = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("author"), F.col("id").alias("n"))
    plain, keyed = scratch_path(spark, "plain"), scratch_path(spark, "keyed")
    size = 64 << 10
    rows.coalesce(1).write.option("parquet.block.size", str(size)).option("parquet.page.size", str(size)) \
        .option("parquet.enable.dictionary", "false").option("parquet.block.size.row.check.min", "100").parquet(plain)
    bucketed.write_keyed(rows.coalesce(1), keyed, ["author"], distinct=2_000, row_group_bytes=size)
    name = rows.filter("n = 41234").first()["author"]
    got = {p: _scanned(spark.read.parquet(p).filter(F.col("author") == name)) for p in (plain, keyed)}
    assert spark.read.parquet(keyed).filter(F.col("author") == name).count() == 1
    assert got[plain] == 60_000 and 0 < got[keyed] < 12_000
    assert _scanned(spark.read.parquet(keyed).filter(F.col("author") == "nobody")) < 6_000


def test_sketch_unions_equal_direct_sketches_and_keep_their_bound(spark):
    rows = spark.range(200_000).select(
        (1704067200 + F.col("id") % 300 * 86400).alias("created_utc"), F.lit("s").alias("subreddit"),
        (F.col("id") * 7 % 50_000).cast("string").alias("author"), (F.col("id") % 90_000).cast("string").alias("link_id"))
    stored = sketches.monthly_sketches(rows)
    got = {r.period: r for r in sketches.all_periods(stored).collect()}
    assert {"2024-Q1", "2024", "all"} <= set(got) and got["all"].total_comments == 200_000
    direct = rows.agg(F.hll_sketch_agg("author", F.lit(sketches.LG_K)).alias("a")) \
        .select(F.hll_sketch_estimate(F.hll_union_agg("a"))).first()[0]
    assert got["all"].distinct_authors == direct
    for period, cond in (("all", "true"), ("2024-Q1", "created_utc < 1711929600")):
        exact = rows.filter(cond).agg(F.count_distinct("author"), F.count_distinct("link_id")).first()
        for estimate, n in zip((got[period].distinct_authors, got[period].distinct_submissions), exact):
            assert abs(estimate - n) <= 4 * sketches.RELATIVE_ERROR * n


def test_frequent_items_keep_their_bound_where_names_do_not_fit(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot"), F.col("id") % 30)).otherwise(
            F.concat(F.lit("rare"), F.col("id"))).alias("author"),
        F.lit("s").alias("subreddit"), (1704067200 + F.col("id") % 120).alias("arrived_at"))
    hours = sketches.combined(sketches.slot_sketches(rows, "author", tracked=1024), 3600, tracked=1024)
    got = sketches.estimated_top(hours, "author", k=10, tracked=1024).collect()
    exact = dict(live.slot_counts(rows, "author", "arrived_at", 3600).select("author", "count").collect())
    assert {r.author for r in got} == {a for a, n in exact.items() if a.startswith("hot")}
    bound = 60_000 * 3.5 / 1024 * 2  # twice the sketch's own bound, as two levels are combined
    assert all(abs(r["count"] - exact[r.author]) <= bound for r in got)


def test_dense_ids_have_no_gaps_and_stay(spark):
    names = spark.createDataFrame([(f"n{i % 300}",) for i in range(900)] + [(None,)], "author string")
    ids = recommend.dense_ids(names, "author")
    assert sorted(r.id for r in ids.collect()) == list(range(300))
    more = recommend.dense_ids(names.union(spark.createDataFrame([("a",), ("zz",)], "author string")), "author", ids)
    before, after = dict(ids.collect()), dict(more.collect())
    assert all(after[n] == i for n, i in before.items()) and (after["a"], after["zz"]) == (300, 301)
    assert recommend.dense_ids(names.limit(0), "author").isEmpty()
    assert sorted(r.id for r in recommend.dense_ids(names, "author", recommend.dense_ids(names.limit(0), "author")).collect()) \
        == list(range(300))


def test_als_on_dense_ids_keeps_colliding_names_apart(spark):
    counts = recommend.interaction_counts(Q._comments(spark, SF001))
    users, items = recommend.dense_ids(counts, "author"), recommend.dense_ids(counts, "subreddit")
    assert users.groupBy("id").count().filter("count > 1").isEmpty()
    ratings = recommend.dense_ratings(counts, users, items)
    assert ratings.count() == counts.count()
    model = recommend.train_als(ratings, blocks=2)
    assert model.userFactors.count() == users.count() and model.itemFactors.count() == items.count()


def test_upkeep_runs_for_ever(spark):
    """Expired days are neither rebuilt nor an error once nothing is left."""
    rate = (1, 120)
    src = Q._landed_records(spark, SF001, rate=rate)
    out, ck = scratch_path(spark, "up"), scratch_path(spark, "up-ck")
    for key, name in (("subreddit", "top_subreddits"), ("author", "top_authors")):
        live_stream.start_slot_trends(live_stream.file_source(spark, src), key, f"{out}/{name}", f"{ck}/{name}",
                                      slot_seconds=3600).awaitTermination()
    live_stream.start_archive(live_stream.file_source(spark, src), f"{out}/archive", f"{ck}/archive").awaitTermination()
    now = Q._newest(spark, SF001, rate) + 3 * 86400
    first = jobs.maintain_live_job(spark, out, now, slot_seconds=3600)
    assert first["expired top_authors"] and not first["repaired top_authors"]
    for later in (60, 86400, 10 * 86400):
        done = jobs.maintain_live_job(spark, out, now + later, slot_seconds=3600)
        assert not any(done.values()), done
    table = sink.read_compacted(spark, f"{out}/top_authors", f"{out}/top_authors_compacted",
                                schema=live_stream.trend_schema("author"))
    assert table.isEmpty() and "slot_total" in table.columns


def test_repair_leaves_the_expired_part_alone(spark):
    rate = (1, 120)
    table = Q._trend_table(spark, SF001, "subreddit", 3600, rate, 120, newest_first=True)
    archive = Q._records(spark, SF001, rate)
    newest, compact = Q._newest(spark, SF001, rate), scratch_path(spark, "rc")
    since = newest // 86400 * 86400 - 86400
    days = live_stream.repair_slots(spark, archive, table, compact, "subreddit", newest - 120, 3600, since=since)
    every = live_stream.repair_slots(spark, archive, table, scratch_path(spark, "rc"), "subreddit", newest - 120, 3600)
    assert days and min(days) == day_label(since) and min(every) < day_label(since)


def test_upsert_keeps_its_number_of_buckets(spark):
    path = scratch_path(spark, "up")
    rows = spark.range(50).select("id", F.lit(1).alias("v"))
    sink.upsert_table(rows, path, ["id"], [F.col("v")], buckets=8)
    sink.upsert_table(rows.withColumn("v", F.lit(2)), path, ["id"], [F.col("v")], buckets=3)
    sink.upsert_table(rows.withColumn("v", F.lit(3)).limit(5), path, ["id"], [F.col("v")])
    got = spark.read.parquet(path)
    assert got.count() == got.select("id").distinct().count() == 50
    assert got.filter("v = 3").count() == 5 and got.filter("v = 2").count() == 45
    assert sink.bucket_number(spark, path) == 8 and len(sink.partitions_of(spark, path, "bucket")) <= 8


def test_one_statement_counts_both_degrees(spark):
    from threadlens.plans import sql
    sql.register_views(spark, Q._comments(spark, SF001))
    want = graph.all_degrees(graph.reply_edges(Q._comments(spark, SF001)))
    got = spark.sql(sql.degrees_sql())
    assert _same(got.select(*want.columns), want)
    tree = explain_string(got).split("\n\n")[0]
    assert len(re.findall("SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin", tree)) == 1

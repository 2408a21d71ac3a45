"""Batch and streaming jobs for a cluster (``spark-submit -m threadlens.jobs``
or ``python -m threadlens.jobs <job> ...``).

Each job reads whole tables, writes its outputs as Parquet, and cuts lineage
by writing intermediate tables (the reply edges) once and reading them back.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from threadlens.functions.timefmt import day_label
from threadlens.operators import graph, history, live, recommend, snapshot
from threadlens.operators.sink import (
    clustered,
    compact_days,
    drop_partition,
    expire_days,
    overwrite_partitions,
    partitions_of,
)
from threadlens.session import scratch_path
from threadlens.sources import json_source, lists

EDGE_MONTHS = ["resp_month", "orig_month"]


def ingest_job(spark: SparkSession, source: str, out: str, dead_out: str, mode: str = "errorifexists"):
    json_source.ingest(spark, source, out, dead_out, mode=mode)


def flashback_job(spark: SparkSession, comments_path: str, out: str, mode: str = "overwrite"):
    """firstpost table: every post, stored in (author, created_utc) order so
    that the per-author read touches few row groups; plus the first-post view."""
    comments = json_source.read_comments_parquet(spark, comments_path)
    clustered(history.posts(comments), ["author"], [F.col("created_utc")]) \
        .write.mode(mode).parquet(f"{out}/firstpost")
    history.first_post_view(history.first_posts(comments)).write.mode(mode).parquet(f"{out}/first_post_view")


def snapshot_job(spark: SparkSession, comments_path: str, out: str, n: int = 100, mode: str = "overwrite"):
    """subredditinfo: the ``n`` busiest subreddits of every month, partitioned
    by (year, month)."""
    comments = json_source.read_comments_parquet(spark, comments_path)
    table = snapshot.top_subreddits_per_month(snapshot.monthly_stats(comments), n)
    (table.sortWithinPartitions("year", "month", F.col("total_comments").desc(), "subreddit")
     .write.mode(mode).partitionBy("year", "month").parquet(f"{out}/subredditinfo"))


def snapshot_month_job(spark: SparkSession, comments_path: str, out: str, year: int, month: int,
                       n: int = 100):
    """Recompute one month of subredditinfo; only that (year, month)
    partition is read (directory pruning) and replaced."""
    comments = json_source.read_comments_parquet(spark, comments_path).filter(
        (F.col("year") == year) & (F.col("month") == month))
    table = snapshot.top_subreddits_per_month(snapshot.monthly_stats(comments), n)
    overwrite_partitions(table, f"{out}/subredditinfo", ["year", "month"])


def _with_month_id(comments):
    return comments.withColumn("month_id", (F.col("year") * 100 + F.col("month")).cast("int"))


def _write_degrees(spark: SparkSession, out: str, edges, mode: str | None = None) -> None:
    """Degrees of each (resp_month, orig_month) pair, next to its edges; files
    sorted so that a per-subreddit read skips row groups by their statistics."""
    degs = graph.all_degrees(edges, by=EDGE_MONTHS).sortWithinPartitions(
        "kind", "subreddit", F.col("rank").desc(), "author")
    if mode:
        degs.write.mode(mode).partitionBy(*EDGE_MONTHS).parquet(f"{out}/degrees")
    else:
        overwrite_partitions(degs, f"{out}/degrees", EDGE_MONTHS)


def current_degrees(spark: SparkSession, out: str):
    """The degree table: the stored pairs of months summed, with map-side
    partial sums."""
    return graph.summed_degrees(spark.read.parquet(f"{out}/degrees"))


def graph_job(spark: SparkSession, comments_path: str, out: str, mode: str = "overwrite"):
    """Edges written once (lineage cut), then degrees and leaders from them.

    Edges and degrees are partitioned by the months of both ends, so the full
    build and ``graph_increment_job`` write the same layout, and a month can be
    added or replaced at any time without touching the other pairs."""
    comments = _with_month_id(json_source.read_comments_parquet(spark, comments_path))
    graph.all_month_edges(comments).write.mode(mode).partitionBy(*EDGE_MONTHS).parquet(f"{out}/edges")
    _write_degrees(spark, out, spark.read.parquet(f"{out}/edges"), mode)
    graph.engagement_of(current_degrees(spark, out)).write.mode(mode).parquet(f"{out}/engagement")


def graph_increment_job(spark: SparkSession, comments_path: str, out: str, year: int, month: int):
    """Add one stored month to the graph tables, or replace it.

    All edges with an end in the month are found again (new replies to any
    parent, old replies to new parents) and their pairs of months replaced, so
    months may come in any order and any number of times.  Pairs that have no
    edges any more go.  The leaders follow from the summed degrees."""
    tag = year * 100 + month
    comments = _with_month_id(json_source.read_comments_parquet(spark, comments_path))
    edges_path = f"{out}/edges"
    before = {p for p in partitions_of(spark, edges_path, *EDGE_MONTHS) if tag in p}
    new = _stored(spark, graph.month_edges(comments, tag), "month-edges")
    now = {(r[0], r[1]) for r in new.select(*EDGE_MONTHS).distinct().collect()}  # pairs of months
    if now:
        overwrite_partitions(new, edges_path, EDGE_MONTHS)
        _write_degrees(spark, out, new)
    for resp, orig in before - now:
        for path in (edges_path, f"{out}/degrees"):
            drop_partition(spark, path, resp_month=resp, orig_month=orig)
    graph.engagement_of(current_degrees(spark, out)).write.mode("overwrite").parquet(f"{out}/engagement")


def recommend_job(spark: SparkSession, comments_path: str, edges_path: str, out: str,
                  block_list: str | None = None, by: str = "outdegree", mode: str = "overwrite"):
    comments = json_source.read_comments_parquet(spark, comments_path)
    block = lists.read_name_list(spark, block_list) if block_list else None
    edges = spark.read.parquet(edges_path)
    recommend.graph_recommend(comments, edges, block, by=by, cut=lambda df: _stored(spark, df, "leaders")) \
        .write.mode(mode).parquet(f"{out}/recommendations")


def _stored(spark: SparkSession, df, name: str):
    """``df`` written to the shared scratch folder and read back."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def als_job(spark: SparkSession, comments_path: str, out: str, n: int = 10, mode: str = "overwrite",
            blocks: int = recommend.ALS_BLOCKS):
    """Counts, id maps, implicit ALS model and top-n recommendations.
    ``blocks`` is part of the model (see ``ALS_BLOCKS``)."""
    comments = json_source.read_comments_parquet(spark, comments_path)
    recommend.interaction_counts(comments).write.mode(mode).parquet(f"{out}/counts")
    counts = spark.read.parquet(f"{out}/counts")
    users = recommend.id_map(counts, "author", "user")
    items = recommend.id_map(counts, "subreddit", "product")
    users.write.mode(mode).parquet(f"{out}/userhash")
    items.write.mode(mode).parquet(f"{out}/producthash")
    recommend.hash_audit(counts, "author").write.mode(mode).parquet(f"{out}/hash_audit")
    model = recommend.train_als(recommend.als_ratings(counts), blocks=blocks)
    model.write().overwrite().save(f"{out}/model")
    recommend.als_recommend(model, spark.read.parquet(f"{out}/userhash"),
                            spark.read.parquet(f"{out}/producthash"), n) \
        .write.mode(mode).parquet(f"{out}/als_recommendations")


def live_job(spark: SparkSession, source, out: str, checkpoint_root: str, slot_seconds: int = 60,
             delay: str = "2 minutes", trigger: str = "10 seconds", available_now: bool = False,
             state_partitions: int | None = None):
    """The live products on one stream of comment JSON: feed + dead letters,
    top subreddits and top authors per slot, and the JSON archive.  Four
    queries, each with its own checkpoint; ``source()`` returns a fresh record
    stream (Kafka on a cluster, landed files in tests).  Stateful queries keep
    their state in RocksDB.  If one query fails, the others are stopped and its
    error is raised."""
    from threadlens.streaming import live_stream as ls
    ls.use_rocksdb_state(spark)
    run = dict(available_now=available_now, processing_time=None if available_now else trigger)
    trends = dict(slot_seconds=slot_seconds, delay=delay, state_partitions=state_partitions, **run)
    queries = [
        ls.start_feed(source(), f"{out}/feed", f"{out}/dead_letters", f"{checkpoint_root}/feed", **run),
        ls.start_slot_trends(source(), "subreddit", f"{out}/top_subreddits", f"{checkpoint_root}/subreddits", **trends),
        ls.start_slot_trends(source(), "author", f"{out}/top_authors", f"{checkpoint_root}/authors", **trends),
        ls.start_archive(source(), f"{out}/archive", f"{checkpoint_root}/archive", **run),
    ]
    try:
        while any(q.isActive for q in queries):
            spark.streams.awaitAnyTermination()   # raises the error of a query that failed
            spark.streams.resetTerminated()
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    return queries


ARCHIVE_SCHEMA = ("author string, parent_id string, score bigint, name string, subreddit string, link_url string, "
                  "created_utc bigint, body string, topic string, partition int, offset bigint, arrived_at bigint, "
                  "day bigint")


def maintain_live_job(spark: SparkSession, out: str, as_of: int, delay: int = 120, slot_seconds: int = 60,
                      trend_ttl: int = live.TREND_TTL_SECONDS, feed_ttl: int = live.FEED_TTL_SECONDS) -> dict:
    """Upkeep of the live tables at time ``as_of``: put back what the trend
    streams dropped as late, compact closed days, drop days past their time to
    live.  Safe to run again, on an idle feed, and beside the streams: it never
    touches a raw batch of a day that is still open.  Repair looks at days that
    have not expired only, so its cost follows the time to live, not the
    archive."""
    from threadlens.streaming import live_stream as ls
    done: dict = {}
    today = day_label(as_of)
    archive = spark.read.schema(ARCHIVE_SCHEMA).json(f"{out}/archive")
    since = (as_of - trend_ttl) // 86400 * 86400  # the first day that has not expired
    for key, name in (("subreddit", "top_subreddits"), ("author", "top_authors")):
        raw, compact = f"{out}/{name}", f"{out}/{name}_compacted"
        done[f"repaired {name}"] = ls.repair_slots(spark, archive, raw, compact, key, as_of - delay, slot_seconds,
                                                 since=since)
        days = sorted({d for (d,) in partitions_of(spark, raw, "day") if d < today})
        compact_days(spark, raw, compact, days, ["minuteslot", "rank"])
        done[f"expired {name}"] = expire_days(spark, [raw, compact], day_label(as_of - trend_ttl))
    days = sorted({d for (d,) in partitions_of(spark, f"{out}/feed", "day") if d < today})
    compact_days(spark, f"{out}/feed", f"{out}/feed_compacted", days, ["secslot"])
    done["expired feed"] = expire_days(spark, [f"{out}/feed", f"{out}/feed_compacted"], day_label(as_of - feed_ttl))
    return done


def main(argv: list[str] | None = None) -> None:
    from threadlens.session import build_session, scale_conf
    p = argparse.ArgumentParser(prog="threadlens.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("source"); a.add_argument("out"); a.add_argument("dead_out")
    a.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite", "replace"],
                   help="replace: overwrite only the months that the source holds")
    for name in ("flashback", "snapshot", "graph", "als"):
        b = sub.add_parser(name); b.add_argument("comments"); b.add_argument("out")
        if name == "als":
            b.add_argument("--blocks", type=int, default=recommend.ALS_BLOCKS)
    r = sub.add_parser("recommend")
    for arg in ("comments", "edges", "out"):
        r.add_argument(arg)
    r.add_argument("--block-list"); r.add_argument("--by", default="outdegree")
    for name in ("snapshot-month", "graph-increment"):
        m = sub.add_parser(name)
        m.add_argument("comments"); m.add_argument("out")
        m.add_argument("year", type=int); m.add_argument("month", type=int)
    lv = sub.add_parser("live")
    for arg in ("servers", "topic", "out", "checkpoint"):
        lv.add_argument(arg)
    lv.add_argument("--slot-seconds", type=int, default=60)
    lv.add_argument("--starting-offsets", default="latest")
    lv.add_argument("--starting-timestamp", type=int, help="epoch ms: skip ahead to this time")
    lv.add_argument("--max-offsets-per-trigger", type=int)
    lv.add_argument("--state-partitions", type=int)
    mt = sub.add_parser("maintain-live")
    mt.add_argument("out"); mt.add_argument("as_of", type=int); mt.add_argument("--slot-seconds", type=int, default=60)
    p.add_argument("--input-bytes", type=int, help="input volume, sizes shuffle partitions")
    args = p.parse_args(argv)
    spark = build_session(app_name=f"threadlens-{args.job}")
    if args.input_bytes:
        for k, v in scale_conf(args.input_bytes, spark.sparkContext.defaultParallelism).items():
            spark.conf.set(k, v)
    if args.job == "ingest":
        ingest_job(spark, args.source, args.out, args.dead_out, args.mode)
    elif args.job == "live":
        from threadlens.streaming.live_stream import kafka_source
        live_job(spark, lambda: kafka_source(spark, args.servers, args.topic, starting_offsets=args.starting_offsets,
                                             max_offsets_per_trigger=args.max_offsets_per_trigger,
                                             starting_timestamp=args.starting_timestamp),
                 args.out, args.checkpoint, args.slot_seconds, state_partitions=args.state_partitions)
    elif args.job == "maintain-live":
        print(maintain_live_job(spark, args.out, args.as_of, slot_seconds=args.slot_seconds))
    elif args.job == "snapshot-month":
        snapshot_month_job(spark, args.comments, args.out, args.year, args.month)
    elif args.job == "graph-increment":
        graph_increment_job(spark, args.comments, args.out, args.year, args.month)
    elif args.job == "recommend":
        recommend_job(spark, args.comments, args.edges, args.out, args.block_list, args.by)
    elif args.job == "als":
        als_job(spark, args.comments, args.out, blocks=args.blocks)
    else:
        {"flashback": flashback_job, "snapshot": snapshot_job, "graph": graph_job}[args.job](
            spark, args.comments, args.out)


if __name__ == "__main__":
    main()

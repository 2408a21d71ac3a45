"""Ingest as a stream, schema drift, lag, fold-in."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from threadlens.operators import live, recommend
from threadlens.plans import queries as Q
from threadlens.session import scratch_path
from threadlens.sources import drift, fixtures, json_source
from threadlens.sources.schema import FEED_PAGE_SCHEMA
from threadlens.streaming import dump_stream, lag, live_stream


def _dump(spark, path, rows):
    spark.createDataFrame([(json.dumps(r) if isinstance(r, dict) else r,) for r in rows], "value string") \
        .coalesce(1).write.text(path)


def _row(i, month="01", **more):
    return {"id": f"c{i}", "author": "a", "created_utc": str(1704067200 + i + 86400 * 31 * (int(month) - 1)), "subreddit": "s", **more}


def test_a_growing_folder_is_read_once_and_a_crash_adds_nothing(spark):
    landing, out, dead, ck, kept = (scratch_path(spark, n) for n in ("l", "o", "d", "k", "arch"))
    _dump(spark, f"{landing}/RC_2024-01", [_row(1), _row(2), "no json"])

    def crash(batch_id):
        raise RuntimeError("lost the driver")
    with pytest.raises(Exception, match="lost the driver"):
        dump_stream.start_ingest_stream(spark, landing, out, dead, ck, after_write=crash).awaitTermination()
    spark.streams.resetTerminated()
    assert spark.read.parquet(out).count() == 2  # written, not committed
    run = lambda: dump_stream.start_ingest_stream(spark, landing, out, dead, ck, archive=kept).awaitTermination()
    run()
    assert sorted(r.id for r in json_source.read_comments_parquet(spark, out).collect()) == ["c1", "c2"]
    _dump(spark, f"{landing}/RC_2024-02", [_row(3, "02"), "{", _row(4, "02")])
    run()
    run()
    got = json_source.read_comments_parquet(spark, out)
    assert sorted((r.id, r.month) for r in got.collect()) == [("c1", 1), ("c2", 1), ("c3", 2), ("c4", 2)]
    bad = spark.read.json(dead)
    assert sorted((r.source_file, r.line) for r in bad.collect()) == [("RC_2024-01", "no json"), ("RC_2024-02", "{")]


def test_unknown_fields_are_kept_and_reported(spark):
    root = scratch_path(spark, "drift")
    _dump(spark, f"{root}/RC_a", [_row(1, stickied=True), _row(2, awards={"gold": 3}), "no json", "[1]"])
    _dump(spark, f"{root}/RC_b", [_row(3, awards={"gold": "many"}), _row(4, stickied="yes", gilded=2)])
    rows = drift.read_with_variant(spark, f"{root}/*")
    got = {r.id: (r.stickied, r.gold, r.gilded) for r in rows.select(
        "id", "gilded", drift.field("$.stickied", "boolean").alias("stickied"),
        drift.field("$.awards.gold", "int").alias("gold")).collect() if r.id}
    assert got == {"c1": (True, None, None), "c2": (None, 3, None), "c3": (None, None, None), "c4": (True, None, 2)}
    unknown = {(r.source_file, r.field, r["rows"]) for r in drift.unknown_fields(rows).collect()}
    assert {("RC_a", "stickied", 1), ("RC_a", "awards", 1), ("RC_b", "stickied", 1), ("RC_b", "awards", 1)} == unknown
    path = scratch_path(spark, "drift-stored")
    rows.write.parquet(path)
    again = spark.read.parquet(path).select(drift.field("$.awards.gold", "int").alias("g")).filter("g = 3")
    assert again.count() == 1
    typed = json_source.typed_comments(json_source.read_raw_comments(spark, f"{root}/*")).filter("id IS NOT NULL")
    mine = rows.select(*typed.columns).filter("id IS NOT NULL")
    assert mine.exceptAll(typed).isEmpty() and typed.exceptAll(mine).isEmpty()


def test_a_stream_that_is_behind_starts_again_near_the_present(spark):
    """Read plus skipped is the whole topic, and dead letters are counted."""
    path = scratch_path(spark, "lag-src")
    live_stream.land_records(Q._messages_with_junk(spark, SF001), path, chunks=6, partitions=2)
    records = spark.read.schema(live_stream.RECORD_SCHEMA).parquet(path)
    newest = records.agg(F.max("timestamp")).first()[0]
    out, ck, report = (scratch_path(spark, n) for n in ("lag-out", "lag-ck", "lag-report"))

    def source(start):
        rows = live_stream.file_source(spark, path)
        return rows if start is None else rows.filter(F.col("timestamp") >= start)

    def write(batch, batch_id, generation):
        batch.select("topic", "partition", "offset").write.mode("overwrite").parquet(f"{out}/generation={generation}/batch={batch_id}")
    runs = lag.follow(spark, source, write, ck, report, max_lag=30, resume_lag=10, clock=lambda: newest, available_now=True)
    assert len(runs) == 2 and runs[0].behind > 30 and runs[1].behind is None
    keys = ["topic", "partition", "offset"]
    read = spark.read.parquet(out).select(*keys)
    skipped = lag.passed_over(records, spark.read.parquet(report)).select(*keys)
    assert skipped.count() > 0 and read.count() == read.distinct().count()
    assert read.count() + skipped.count() == records.count()
    assert read.unionByName(skipped).distinct().count() == records.count()
    dead = live.parse_messages(records.join(read, keys)).filter("_corrupt_record IS NOT NULL").count()
    assert sum(b["dead"] for r in runs for b in r.batches) == dead > 0


def test_a_stream_in_time_is_left_alone(spark):
    path = scratch_path(spark, "ok-src")
    live_stream.land_records(Q._messages(spark, SF001), path, chunks=2)
    out, ck, report = (scratch_path(spark, n) for n in ("ok-out", "ok-ck", "ok-report"))
    newest = spark.read.parquet(path).agg(F.max("timestamp")).first()[0]
    runs = lag.follow(spark, lambda start: live_stream.file_source(spark, path),
                      lambda b, n, g: b.write.mode("overwrite").parquet(f"{out}/generation={g}/batch={n}"), ck, report,
                      max_lag=10**6, clock=lambda: newest, available_now=True)
    assert [r.behind for r in runs] == [None] and spark.read.parquet(out).count() == spark.read.parquet(path).count()


def test_fold_in_is_the_trainings_own_step(spark):
    counts = recommend.interaction_counts(Q._comments(spark, SF001))
    ratings = recommend.dense_ratings(counts, recommend.dense_ids(counts, "author"), recommend.dense_ids(counts, "subreddit"))
    model = recommend.train_als(ratings, blocks=2)
    own = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    folded = {r.id: np.array(r.features) for r in recommend.fold_in(model.itemFactors, ratings).collect()}
    assert own.keys() == folded.keys()
    assert max(np.abs(own[u] - folded[u]).max() for u in own) < 1e-5 * max(np.abs(v).max() for v in own.values()) + 1e-6
    new = spark.createDataFrame([(999, 0, 3.0), (999, 1, 0.0), (998, 12345, 1.0)], "user int, item int, rating float")
    assert [r.id for r in recommend.fold_in(model.itemFactors, new).collect()] == [999]


def test_landed_pages_read_back_whole(spark):
    """Pages landed as JSON hold every page and comment of those in memory."""
    pages = live.pages_from_records(fixtures.load_comments(spark, SF001, with_arrival=True))
    landed = Q._landed_pages(spark, SF001)
    assert landed.schema == FEED_PAGE_SCHEMA
    flat, want = live.flatten_pages(landed), live.flatten_pages(pages)
    assert flat.count() == want.count() > 1000
    assert flat.exceptAll(want).isEmpty()

"""Slots closed by timers, and stored high-water marks."""

import json
import time

import pytest
from pyspark.sql import Row

from threadlens.operators import live
from threadlens.operators.sink import partitions_of
from threadlens.plans import queries as Q
from threadlens.session import scratch_path
from threadlens.streaming import high_water, live_stream, ticks

from conftest import SF001


def _messages(spark, rows):
    """rows: (offset, arrived_at, subreddit, author)."""
    return spark.createDataFrame([(o, at, json.dumps({"subreddit": s, "author": a, "body": "x", "created_utc": at}))
                                  for o, at, s, a in rows], "offset long, arrived_at long, value string")


def _land(spark, path, rows, mode="append"):
    live_stream.land_records(_messages(spark, rows), path, chunks=1, mode=mode)


def _stored(spark, out):
    if not partitions_of(spark, out, "day"):
        return []
    return sorted((r.kind, r.name, r["count"], r.late) for r in spark.read.parquet(out).collect())


def _wait(spark, out, n, seconds=60):
    until = time.time() + seconds
    while time.time() < until and len(_stored(spark, out)) < n:
        time.sleep(0.5)
    return _stored(spark, out)


def test_a_clock_closes_slots_and_ttl_forgets_them(spark):
    """Nothing arrives after the only message, and its slot closes all the same
    once its time has come; a message for a closed slot is a correction while
    the slot is remembered, and a slot of its own after the time to live."""
    src, out, ck = (scratch_path(spark, n) for n in ("t-src", "t-out", "t-ck"))
    slot = 4
    _land(spark, src, [(0, int(time.time()) - 3600, "warm", "up")])
    q = ticks.start_ticks(live_stream.file_source(spark, src), out, ck, slot_seconds=slot, linger=1, ttl=20,
                          state_partitions=2)
    try:
        warm = _wait(spark, out, 2)
        assert len(warm) == 2
        now = int(time.time()) // slot * slot + 24  # a slot that lies ahead
        _land(spark, src, [(1, now, "s", "a"), (2, now, "s", "b"), (3, now, None, "c"), (4, now + slot, "s", "a")])
        while time.time() < now - 1:
            time.sleep(0.2)
        assert _stored(spark, out) == warm  # read and counted, but not closed before its end
        first = [r for r in _wait(spark, out, 7) if r not in warm]
        assert first == [("author", "a", 1, False), ("author", "a", 1, False), ("author", "b", 1, False),
                         ("subreddit", "s", 1, False), ("subreddit", "s", 2, False)]
        assert time.time() >= now + slot + 1
        _land(spark, src, [(5, now + slot, "s", "b")])
        again = _wait(spark, out, 9)
        assert ("subreddit", "s", 1, True) in again and again.count(("author", "b", 1, False)) == 2
        time.sleep(25)
        _land(spark, src, [(6, now + slot, "s", "b")])
        forgotten = _wait(spark, out, 11)
        assert sum(late for *_, late in forgotten) == 1 and len(forgotten) == 11
    finally:
        q.stop()
    counts = {(r.kind, r.name, r.slot_start): r["count"] for r in ticks.closed_counts(spark.read.parquet(out)).collect()}
    assert counts[("subreddit", "s", now + slot)] == 3  # corrections add up


def _pages(spark, newest_first=False):
    path = scratch_path(spark, "hw-pages")
    pages = Q._feed_pages(spark, SF001)
    if newest_first:
        for cond in ("page >= 5", "page < 5"):
            live_stream.land_pages(pages.filter(cond), path, chunks=1)
    else:
        live_stream.land_pages(pages, path)
    return path, pages


def _read_feeds(spark, path):
    out, marks, late, ck = (scratch_path(spark, n) for n in ("hw-out", "hw-marks", "hw-late", "hw-ck"))
    high_water.start_high_water(spark, path, out, marks, late, ck).awaitTermination()
    return out, marks, late, ck


def test_one_mark_per_feed_and_no_key_per_comment(spark):
    path, pages = _pages(spark)
    out, marks, late, ck = _read_feeds(spark, path)
    rows = high_water.flatten_feeds(pages)
    want = {(r.feed, r.m) for r in rows.groupBy("feed").agg({"code": "max"}).toDF("feed", "m").collect()}
    assert {tuple(r) for r in high_water.marks_before(spark, marks).collect()} == want and len(want) == 3
    assert len(partitions_of(spark, marks, "batch")) == 4
    assert spark.read.parquet(out).count() == rows.select("feed", "code").distinct().count()
    assert not partitions_of(spark, late, "batch")
    # the mark outlives the run: nothing is read twice
    live_stream.land_pages(pages, path, chunks=1)
    high_water.start_high_water(spark, path, out, marks, late, ck).awaitTermination()
    assert spark.read.parquet(out).count() == rows.select("feed", "code").distinct().count()
    assert spark.read.parquet(late).count() == pages.count()


def test_late_pages_are_reported(spark):
    path, pages = _pages(spark, newest_first=True)
    out, _, late, _ = _read_feeds(spark, path)
    told = {(r.feed, r.page, r.comments) for r in spark.read.parquet(late).collect()}
    rows = high_water.flatten_feeds(pages)
    assert told == {tuple(r) for r in rows.filter("page < 5").groupBy("feed", "page").count().collect()} and told
    got = spark.read.parquet(out).select("feed", "code")
    lost = rows.select("feed", "code").distinct().subtract(got)
    assert lost.subtract(rows.filter("page < 5").select("feed", "code")).isEmpty() and not lost.isEmpty()


def test_a_replayed_batch_starts_from_the_marks_before_it(spark):
    path = scratch_path(spark, "hw-replay")
    for batch, marks in ((0, [("a", 5)]), (1, [("a", 9), ("b", 2)])):
        spark.createDataFrame(marks, high_water.MARKS).write.parquet(f"{path}/batch={batch}")
    assert {tuple(r) for r in high_water.marks_before(spark, path, 1).collect()} == {("a", 5)}
    assert {tuple(r) for r in high_water.marks_before(spark, path, 2).collect()} == {("a", 9), ("b", 2)}
    assert high_water.marks_before(spark, path, 0).isEmpty()
    assert live.TREND_TTL_SECONDS == 300


class _Calls:
    """A state handle and list state that count their calls."""

    def __init__(self, calls=None):
        self.calls, self.rows = ([] if calls is None else calls), []

    def getListState(self, *a, **kw):
        return _Calls(self.calls)

    def registerTimer(self, ms):
        self.calls.append(ms)

    def exists(self):
        self.calls.append("exists")
        return bool(self.rows)

    def appendValue(self, row):
        self.calls.append("append")
        self.rows.append(row)

    def get(self):
        self.calls.append("get")
        return iter(self.rows)

    def clear(self):
        self.calls.append("clear")
        self.rows.clear()


def test_state_calls_do_not_grow_with_names():
    counter, handle = ticks.SlotCounter(60, 5, 300), _Calls()
    counter.init(handle)
    key = ("author", 600, 3)
    for _ in range(2):
        list(counter.handleInputRows(key, [Row(name=f"u{n}") for n in range(5000)], None))
    rows = list(counter.handleExpiredTimer(key, None, None))
    assert {(r.name, r["count"], r.late) for r in rows} == {(f"u{n}", 2, False) for n in range(5000)}
    assert len(handle.calls) < 12 and [c for c in handle.calls if isinstance(c, int)] == [665_000]
    list(counter.handleInputRows(key, [Row(name="u7"), Row(name="new")], None))
    rows = list(counter.handleExpiredTimer(key, None, None))
    assert {(r.name, r["count"], r.late) for r in rows} == {("u7", 1, True), ("new", 1, False)}


def test_closed_slots_are_written_by_every_state_partition(spark):
    src, out, ck = (scratch_path(spark, n) for n in ("p-src", "p-out", "p-ck"))
    _land(spark, src, [(n, 1704153540 + n, f"s{n % 7}", f"u{n}") for n in range(300)])
    ticks.drain(ticks.start_ticks(live_stream.file_source(spark, src), out, ck, state_partitions=4))
    table = spark.read.parquet(out)
    assert len(table.inputFiles()) > len(partitions_of(spark, out, "day", "batch"))
    assert ticks.closed_counts(table).agg({"count": "sum"}).first()[0] == 600


class _Busy:
    """A query that still reads when its time is up."""
    isActive, lastProgress, stopped = True, {"numInputRows": 5, "batchId": 0}, False

    def exception(self):
        return None

    def stop(self):
        self.stopped = True


def test_a_drain_cut_short_is_an_error():
    query = _Busy()
    with pytest.raises(TimeoutError):
        ticks.drain(query, timeout=0.3)
    assert query.stopped

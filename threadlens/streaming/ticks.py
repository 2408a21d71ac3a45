"""Slots closed by a clock: keyed counters whose timers, not a later message,
end a slot.

Every record counts once for its subreddit and once for its author; both
listeners share one read of the topic and one state.  The counts of a slot are
kept per (kind, slot, part), a part being a share of the names by their hash:
a batch adds one list of (name, count) to each, so the calls to the state grow
with slots and not with names, and a busy subreddit holds one number per
batch, never its records.  Slots follow arrival, and a processing-time timer
per (kind, slot, part) fires ``linger`` seconds after the slot's end: the
counts go out and leave the state.  The names of a closed slot are remembered
for ``ttl`` seconds; what still comes in for one of them goes out as a
correction (``late``), so the sums of all rows are exact however a topic is
cut into batches.  The state store drops forgotten slots by its own time to
live.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from threadlens.functions.timefmt import day_number, minute_slot, slot_start
from threadlens.operators import live
from threadlens.operators.common import top_per_group
from threadlens.operators.sink import overwrite_partitions
from threadlens.streaming.live_stream import _start

KINDS = ("subreddit", "author")
#: Shares of a slot's names, each counted by its own key of the state.
PARTS = 8
OUT = "kind string, name string, slot_start long, count long, late boolean"


class SlotCounter(StatefulProcessor):
    """Counts of one (kind, slot, part) while its slot is open; the names of a
    closed slot under a TTL."""

    def __init__(self, slot_seconds: int, linger: int, ttl: int):
        self.slot_seconds, self.linger, self.ttl = slot_seconds, linger, ttl

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "names array<string>, counts array<long>")  # the timer clears it
        self.closed = handle.getListState("closed", "names array<string>", ttlDurationMs=1000 * self.ttl)

    def _closes_ms(self, slot: int) -> int:
        return 1000 * (slot + self.slot_seconds + self.linger)

    def handleInputRows(self, key, rows: Iterable, timerValues) -> Iterator[Row]:
        counts = Counter(r.name for r in rows)
        if not self.open.exists():
            self.handle.registerTimer(self._closes_ms(key[1]))
        self.open.appendValue((list(counts), list(counts.values())))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        counts: Counter = Counter()
        for names, numbers in self.open.get():
            counts.update(dict(zip(names, numbers)))
        self.open.clear()
        told = {n for (names,) in self.closed.get() for n in names}
        self.closed.appendValue((list(counts),))
        for name, n in counts.items():
            yield Row(kind=key[0], name=name, slot_start=key[1], count=n, late=name in told)

    def close(self) -> None:
        pass


def listened(records: DataFrame, slot_seconds: int = 60) -> DataFrame:
    """(kind, name, slot_start): a row per record and listener; records without
    author or subreddit are skipped by both."""
    good = live.good_records(live.parse_messages(records.withColumnRenamed("timestamp", "arrived_at")))
    names = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("name")) for k in KINDS]))
    return good.dropna(subset=list(KINDS)).select(names.alias("to"), slot_start("arrived_at", slot_seconds)
                                                  .alias("slot_start")).select("to.*", "slot_start")


def start_ticks(records: DataFrame, sink_path: str, checkpoint: str, slot_seconds: int = 60, linger: int = 5,
                ttl: int = live.TREND_TTL_SECONDS, processing_time: str = "1 second",
                state_partitions: int | None = None, parts: int = PARTS) -> StreamingQuery:
    """Count per slot for both listeners and append what closes to ``sink_path``
    in (day, batch) folders, which a replayed batch overwrites; each state
    partition writes what it closes.  ``parts`` spreads a slot with very many
    names and stays as the checkpoint was started.  A clock needs a running
    query, so there is no ``availableNow``; see ``drain``."""
    named = listened(records, slot_seconds).withColumn("part", F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int"))
    closed = named.groupBy("kind", "slot_start", "part").transformWithState(
        SlotCounter(slot_seconds, linger, ttl), OUT, "append", "processingTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("day", day_number("slot_start")).withColumn("batch", F.lit(batch_id))
        overwrite_partitions(rows, sink_path, ["day", "batch"])
    return _start(closed.writeStream.foreachBatch(write), checkpoint, False, processing_time, records.sparkSession,
                  state_partitions, rocksdb=True)


def drain(query: StreamingQuery, quiet_batches: int = 2, timeout: float | None = None) -> None:
    """Wait until the source has been read and ``quiet_batches`` batches without
    input have passed, then stop the query; an error of the query is raised.
    A ``timeout`` (seconds) that passes before also stops it and is an error:
    what the query had not read yet would be missing."""
    until, first, drained = time.time() + (timeout or float("inf")), None, False
    while query.isActive and time.time() < until and not drained:
        last = query.lastProgress
        if last is None or last["numInputRows"]:
            first = None
        elif first is None:
            first = last["batchId"]
        else:
            drained = last["batchId"] - first >= quiet_batches
        time.sleep(0.1)
    if query.exception() is not None:
        raise query.exception()
    query.stop()
    if not drained:
        raise TimeoutError("the query ended before its source was read")


def closed_counts(table: DataFrame) -> DataFrame:
    """(kind, name, slot_start, count) of stored ticks, corrections added."""
    return table.groupBy("kind", "name", "slot_start").agg(F.sum("count").alias("count"))


def tick_trends(table: DataFrame, k: int = live.TOP_K, on: Column | None = None) -> DataFrame:
    """The ``k`` largest counts of every slot and kind, ranked, ties by name."""
    counts = closed_counts(table if on is None else table.filter(on)) \
        .withColumn("minuteslot", minute_slot("slot_start"))
    return top_per_group(counts, ["kind", "minuteslot"], [F.col("count").desc(), F.col("name")], k, position="rank") \
        .select("kind", "minuteslot", "name", "count", "rank")

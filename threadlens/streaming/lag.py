"""Lag and error counters of a live stream, and a restart ahead of a backlog.

Every micro-batch counts its rows, its dead letters and its newest arrival while
it runs (``observe``); a listener turns them into lag.  A stream that has fallen
more than ``max_lag`` seconds behind does not chase its backlog: it ends before
its next batch and starts again near the present with a fresh checkpoint, and a
report names, per topic partition, the offsets that were passed over.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from threadlens.operators import live
from threadlens.sources.schema import CORRUPT_COLUMN

METRICS = "live"
REPORT = "generation int, topic string, partition int, after_offset long, from_timestamp long, lag long"


class LagListener(StreamingQueryListener):
    """Lag and dead letters per batch; ``behind`` once the lag passes ``max_lag``."""

    def __init__(self, max_lag: int, clock: Callable[[], float] = time.time):
        self.max_lag, self.clock = max_lag, clock
        self.batches: list[dict] = []
        self.behind: int | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(METRICS)
        if seen is None or seen["newest"] is None:
            return
        lag = int(self.clock()) - seen["newest"]
        self.batches.append({"batch": event.progress.batchId, "rows": seen["rows"], "dead": seen["dead"], "lag": lag})
        if lag > self.max_lag and self.behind is None:
            self.behind = lag

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class _Behind(Exception):
    """Ends a stream between two batches."""


def follow(spark: SparkSession, source: Callable[[int | None], DataFrame],
           write: Callable[[DataFrame, int, int], None], checkpoint_root: str, report_path: str, max_lag: int,
           resume_lag: int = 0, clock: Callable[[], float] = time.time, available_now: bool = False,
           processing_time: str = "10 seconds") -> list[LagListener]:
    """Run ``write(parsed batch, batch id, generation)`` over ``source(from)``,
    a stream of records from an arrival second on (None: from its beginning).

    A generation has its own checkpoint and, as batch ids begin anew, should
    have its own output folder.  When the listener finds a generation behind,
    the batch that would come next is not written; the next generation starts
    ``resume_lag`` seconds before now.  What lies between the last written
    offset and that second is reported in ``report_path``.  Returns the
    listeners of all generations.
    """
    done, start, generation = [], None, 0
    while True:
        listener, written = LagListener(max_lag, clock), {}
        spark.streams.addListener(listener)

        def each(batch: DataFrame, batch_id: int) -> None:
            if listener.behind is not None:
                raise _Behind
            batch.persist()  # each pass over the batch would count it again
            try:
                write(batch, batch_id, generation)
                for r in batch.groupBy("topic", "partition").agg(F.max("offset").alias("last")).collect():
                    key = (r["topic"], r["partition"])  # a row per topic partition
                    written[key] = max(r["last"], written.get(key, -1))
            finally:
                batch.unpersist()
        parsed = live.parse_messages(source(start).withColumnRenamed("timestamp", "arrived_at")).observe(
            METRICS, F.count(F.lit(1)).alias("rows"), F.max("arrived_at").alias("newest"),
            F.count(F.when(F.col(CORRUPT_COLUMN).isNotNull(), 1)).alias("dead"))
        w = parsed.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint_root}/generation={generation}")
        query = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()
        try:
            query.awaitTermination()
        except Exception:
            if listener.behind is None:
                raise
        finally:
            spark.streams.removeListener(listener)
            spark.streams.resetTerminated()
        done.append(listener)
        if listener.behind is None or query.exception() is None:
            return done
        start = int(clock()) - resume_lag
        spark.createDataFrame([(generation, t, p, last, start, listener.behind) for (t, p), last in written.items()], REPORT) \
            .coalesce(1).write.mode("append").parquet(report_path)
        generation += 1


def passed_over(records: DataFrame, report: DataFrame) -> DataFrame:
    """The records (from an archive or a replay of the topic) that a report says
    were skipped."""
    r = F.broadcast(report)  # a row per restart and topic partition
    hit = (records["topic"] == r["topic"]) & (records["partition"] == r["partition"]) \
        & (records["offset"] > r["after_offset"]) & (records["timestamp"] < r["from_timestamp"])
    return records.join(r, hit, "left_semi")

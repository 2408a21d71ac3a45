"""Polled feeds with a stored high-water mark.

A poller's cursor is one number per feed: the highest comment code read so far.
It is kept in a table beside the stream, one row per feed and batch, so the
state never grows with the comments, and a batch that is replayed reads the
marks of the batch before it and overwrites its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from threadlens.operators import live
from threadlens.operators.sink import drop_partition, overwrite_partitions, partitions_of
from threadlens.sources.schema import FEED_PAGE_SCHEMA
from threadlens.streaming.live_stream import _start

PAGE_SCHEMA = StructType([*FEED_PAGE_SCHEMA.fields]).add("feed", StringType())
MARKS = "feed string, mark long"


def marks_before(spark: SparkSession, marks_path: str, batch_id: int | None = None) -> DataFrame:
    """(feed, mark) as the newest batch before ``batch_id`` (default: any) left it."""
    done = [b for (b,) in partitions_of(spark, marks_path, "batch") if batch_id is None or b < batch_id]
    if not done:
        return spark.createDataFrame([], MARKS)
    return spark.read.schema(MARKS).parquet(f"{marks_path}/batch={max(done)}")


def flatten_feeds(pages: DataFrame) -> DataFrame:
    """Pages of several feeds -> one row per comment, with feed and code."""
    rows = pages.select("feed", "page", "polled_at", F.explode("data.children").alias("c"))
    return rows.select("feed", "page", "polled_at", "c.data.*").withColumn("code", live.base36_to_long("id"))


def start_high_water(spark: SparkSession, pages_path: str, sink_path: str, marks_path: str, late_path: str,
                     checkpoint: str, keep_marks: int = 10, available_now: bool = True,
                     processing_time: str | None = None, max_files_per_trigger: int | None = 1) -> StreamingQuery:
    """Emit each feed's comments above its mark, each once, then raise the mark.

    The filter runs before the shuffle that collapses a batch's overlapping
    pages, and marks are a partially aggregated maximum, so no task holds a
    feed.  A page wholly at or below the mark it met came late: it is reported
    in ``late_path`` (feed, page, comments, newest code, mark).  Marks of the
    last ``keep_marks`` batches are kept.
    """
    reader = spark.readStream.schema(PAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.parquet(pages_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        session, number = batch.sparkSession, F.lit(batch_id)
        before = marks_before(session, marks_path, batch_id)
        rows = flatten_feeds(batch)
        met = rows.join(before, "feed", "left")
        fresh = met.filter(F.col("mark").isNull() | (F.col("code") > F.col("mark"))) \
            .dropDuplicates(["feed", "code"]).drop("page", "polled_at", "mark")
        overwrite_partitions(fresh.withColumn("batch", number), sink_path, ["batch"])
        late = met.groupBy("feed", "page").agg(F.count(F.lit(1)).alias("comments"), F.max("code").alias("newest"),
                                               F.max("mark").alias("mark")).filter("newest <= mark")
        overwrite_partitions(late.withColumn("batch", number), late_path, ["batch"])
        marks = rows.select("feed", F.col("code").alias("mark")).unionByName(before) \
            .groupBy("feed").agg(F.max("mark").alias("mark"))
        overwrite_partitions(marks.withColumn("batch", number).coalesce(1), marks_path, ["batch"])
        for (old,) in partitions_of(session, marks_path, "batch"):
            if old <= batch_id - keep_marks:
                drop_partition(session, marks_path, batch=old)
    return _start(pages.writeStream.foreachBatch(write), checkpoint, available_now, processing_time)

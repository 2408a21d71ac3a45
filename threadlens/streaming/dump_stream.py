"""Ingest as a stream of files: a folder into which dumps are dropped is read
once, whatever it is called with and however often.

The file source's checkpoint remembers which files were read, so a run finds
the new months by itself and a rerun finds nothing.  Every micro-batch
overwrites its own (year, month, batch) folders, so a batch that is replayed
after a crash adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from threadlens.operators.sink import overwrite_partitions
from threadlens.sources import json_source
from threadlens.sources.schema import CORRUPT_COLUMN, RAW_COMMENT_SCHEMA
from threadlens.streaming.live_stream import _start


def start_ingest_stream(spark: SparkSession, landing: str, out: str, dead_out: str, checkpoint: str,
                        max_files_per_trigger: int | None = None, archive: str | None = None,
                        available_now: bool = True, processing_time: str | None = None,
                        after_write: Callable[[int], None] | None = None) -> StreamingQuery:
    """Read the dumps that landed since the last run (``availableNow``) or keep
    reading.  ``archive`` moves files there once a later batch has committed
    them, which keeps the listing of ``landing`` short.  ``after_write`` is
    called between a batch's write and its commit."""
    schema = T.StructType([*RAW_COMMENT_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    raw = reader.json(landing).withColumn("source_file", json_source.table_name_of(F.col("_metadata.file_path")))

    def write(batch: DataFrame, batch_id: int) -> None:
        number = F.lit(batch_id)
        rows = json_source.with_month(json_source.typed_comments(batch)).withColumn("batch", number)
        overwrite_partitions(rows.sortWithinPartitions("year", "month", "author", "created_utc", "id"), out,
                             ["year", "month", "batch"])
        dead = batch.filter(F.col(CORRUPT_COLUMN).isNotNull()) \
            .select("id", F.col(CORRUPT_COLUMN).alias("line"), "source_file", number.alias("batch"))
        overwrite_partitions(dead, dead_out, ["source_file", "batch"], file_format="json")
        if after_write:
            after_write(batch_id)
    return _start(raw.writeStream.foreachBatch(write), checkpoint, available_now, processing_time)

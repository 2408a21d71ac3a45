"""Raw JSON dumps -> typed, month-partitioned Parquet.

One job covers every monthly file (a glob or directory), instead of one
driver process per month: the month of a row comes from its own timestamp and
becomes a ``year=/month=`` directory partition, so later jobs prune months by
directory and push row-level filters into Parquet statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.timefmt import utc_month, utc_year
from threadlens.operators.sink import overwrite_partitions
from threadlens.sources.schema import COMMENT_COLUMNS, CORRUPT_COLUMN, RAW_COMMENT_SCHEMA


def read_raw_comments(spark: SparkSession, path: str, keep_corrupt: bool = True,
                      with_source: bool = False) -> DataFrame:
    """JSON lines with the declared schema; a missing field reads as NULL and an
    unparsable line keeps its text in ``_corrupt_record`` (PERMISSIVE mode).
    ``with_source`` adds ``source_file``, the dump's file name (its month)."""
    schema = RAW_COMMENT_SCHEMA
    reader = spark.read.option("mode", "PERMISSIVE")
    if keep_corrupt:
        # a new StructType: .add() would mutate the shared schema in place
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    df = reader.schema(schema).json(path)
    if with_source:
        df = df.withColumn("source_file", table_name_of(F.input_file_name()))
    return df


def typed_comments(raw: DataFrame) -> DataFrame:
    """Well-formed raw rows -> typed comments, in ``COMMENT_COLUMNS`` order.
    ``created_utc`` arrives as text; a value that is no integer becomes NULL."""
    typed = {"created_utc": F.col("created_utc").try_cast("bigint")}
    good = raw.filter(F.col(CORRUPT_COLUMN).isNull()) if CORRUPT_COLUMN in raw.columns else raw
    return good.select(*[typed.get(c, F.col(c)).alias(c) for c in COMMENT_COLUMNS])


def dead_letters(raw: DataFrame) -> DataFrame:
    """Lines of a raw read that did not parse, with the dump they came from and
    the comment id where it could be read (Spark also wants one real column of
    a scan to be used besides the corrupt record)."""
    bad = raw.select("id", CORRUPT_COLUMN, table_name_of(F.input_file_name()).alias("source_file"))
    return bad.filter(F.col(CORRUPT_COLUMN).isNotNull()).withColumnRenamed(CORRUPT_COLUMN, "line")


def with_month(df: DataFrame, epoch_col: str = "created_utc") -> DataFrame:
    return df.withColumn("year", utc_year(epoch_col)).withColumn("month", utc_month(epoch_col))


def write_comments_parquet(comments: DataFrame, path: str, mode: str = "errorifexists",
                           cluster_by: str = "author", layout: str = "local",
                           num_files: int | None = None) -> None:
    """Write typed comments partitioned by (year, month), rows ordered by
    (``cluster_by``, created_utc, id) inside every file.

    ``layout="local"`` (default) sorts each input split and writes it: one
    pass, no shuffle, nothing a hot author or month can skew.  Each row group
    covers a narrow ``cluster_by`` range, so Parquet min/max statistics skip
    most row groups of a keyed read (all posts of one author), though every
    file footer is consulted.

    ``layout="range"`` range-partitions on the same key first, so each file
    holds a disjoint key range and a keyed read opens few files.  Spark
    samples the input for the range bounds (an extra pass over the upstream
    plan), and because the key ends in created_utc and id, a hot author is
    still cut across several tasks.

    ``mode="replace"`` overwrites only the (year, month) folders present.
    """
    keys = ["year", "month", cluster_by, "created_utc", "id"]
    df = with_month(comments)
    if layout == "range":
        df = df.repartitionByRange(num_files, *keys) if num_files else df.repartitionByRange(*keys)
    elif layout != "local":
        raise ValueError(f"unknown layout {layout!r}")
    df = df.sortWithinPartitions(*keys)
    if mode == "replace":
        overwrite_partitions(df, path, ["year", "month"])
    else:
        df.write.mode(mode).partitionBy("year", "month").parquet(path)


def ingest(spark: SparkSession, source: str, out: str, dead_out: str, mode: str = "errorifexists",
           layout: str = "local") -> None:
    """The ingest job over the dump files under ``source`` (glob or folder):
    typed comments by (year, month), and the lines that did not parse by dump.

    Two scans, nothing cached: the second one parses again but keeps only the
    broken lines.  ``mode="replace"`` overwrites just the months and dumps that
    ``source`` holds, so a month can be added, or ingested again, at any time.
    """
    raw = read_raw_comments(spark, source)
    write_comments_parquet(typed_comments(raw), out, mode=mode, layout=layout)
    dead = dead_letters(raw)
    if mode == "replace":
        overwrite_partitions(dead, dead_out, ["source_file"], file_format="json")
    else:
        dead.write.mode(mode).partitionBy("source_file").json(dead_out)


def read_comments_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_name_of(path_col) -> "F.Column":
    """The dump's name: the last part of the path, or the folder's name for a
    ``part-`` file inside it, without file extensions."""
    col = F.col(path_col) if isinstance(path_col, str) else path_col
    last = F.regexp_extract(col, r"([^/]+?)(?:/part-[^/]*)?$", 1)
    return F.regexp_extract(last, r"^([^.]*)", 1)

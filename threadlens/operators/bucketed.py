"""Stored layouts that save later shuffles and reads.

The reply graph joins comments to their parents.  Stored once as two tables,
bucketed alike on the parent's full name, every later join runs bucket by
bucket without an exchange.  A parent with more than ``hot_rows`` replies would
fill one bucket, so its replies lie in a third, unbucketed table and meet the
few hot parents in an ordinary join, whose skew Spark splits at run time.

Keyed reads (an author's history, one comment) use Parquet bloom filters, which
rule out row groups where minimum and maximum can't.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators.graph import EDGE_COLUMNS, _edge_sides

KEY = "_key"
HOT_ROWS = 1_000_000
BUCKETS = 64


def attach_bucketed(spark: SparkSession, name: str, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """Name a bucketed folder in this session's catalog; nothing is read."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Store ``df`` as one sorted file per bucket of ``key`` and name it."""
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).mode("overwrite").saveAsTable(name))
    return df.sparkSession.table(name)


def store_reply_sides(comments: DataFrame, name: str, path: str, buckets: int = BUCKETS,
                      hot_rows: int = HOT_ROWS) -> None:
    """Write the parents and the replies of ``reply_edges`` as tables
    ``<name>_parents``, ``<name>_replies`` (bucketed) and ``<name>_hot``."""
    parents, replies = _edge_sides(comments)
    hot = replies.groupBy(KEY).count().filter(F.col("count") > hot_rows).select(KEY)
    write_bucketed(parents, f"{name}_parents", f"{path}/parents", KEY, buckets)
    write_bucketed(replies.join(hot, KEY, "left_anti"), f"{name}_replies", f"{path}/replies", KEY, buckets)
    replies.join(hot, KEY, "left_semi").write.mode("overwrite").parquet(f"{path}/hot")
    comments.sparkSession.read.parquet(f"{path}/hot").createOrReplaceTempView(f"{name}_hot")


def attach_reply_sides(spark: SparkSession, comments_schema: DataFrame, name: str, path: str,
                       buckets: int = BUCKETS) -> None:
    """Name the stored tables again in another session."""
    for side, frame in zip(("parents", "replies"), _edge_sides(comments_schema)):
        schema = ", ".join(f"`{c}` {t}" for c, t in frame.dtypes)
        attach_bucketed(spark, f"{name}_{side}", f"{path}/{side}", schema, KEY, buckets)
    spark.read.parquet(f"{path}/hot").createOrReplaceTempView(f"{name}_hot")


def stored_reply_edges(spark: SparkSession, name: str) -> DataFrame:
    """``reply_edges`` from the stored tables: a join of equal buckets, and the
    replies to hot parents beside it."""
    parents, hot = spark.table(f"{name}_parents"), spark.table(f"{name}_hot")
    cool = parents.join(spark.table(f"{name}_replies"), KEY)
    return cool.select(*EDGE_COLUMNS).unionByName(parents.join(hot, KEY).select(*EDGE_COLUMNS))


def write_keyed(df: DataFrame, path: str, keys: Sequence[str], distinct: int = 1_000_000,
                row_group_bytes: int | None = None, mode: str = "errorifexists") -> None:
    """Write Parquet with a bloom filter per row group on each of ``keys``, for
    reads by equality; ``distinct`` is the number of values expected in a row
    group and sets the filter's size."""
    w = df.write.mode(mode).option("parquet.enable.dictionary", "false")
    for key in keys:
        w = w.option(f"parquet.bloom.filter.enabled#{key}", "true") \
             .option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct))
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes)).option("parquet.page.size", str(row_group_bytes)) \
             .option("parquet.block.size.row.check.min", "100")
    w.parquet(path)

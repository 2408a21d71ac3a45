"""Key-value table semantics on files: upsert by key, retention, idempotent
partition overwrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators.common import top_per_group


def upsert_latest(rows: DataFrame, keys: Sequence[str], version: Sequence[Column]) -> DataFrame:
    """Last write wins per primary key: the row with the greatest ``version``.

    This is what appending into a keyed store does; as a window top-1 it is
    planned with a partial per-task limit, so a hot key cannot pile up rows.
    """
    return top_per_group(rows, list(keys), [v.desc() for v in version], 1)


def clustered(table: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Storage order of a clustered table (partition key, then clustering
    columns).  Range partitioning on the whole order cuts a hot key across
    several files instead of one task; rows are sorted inside each file
    (readers still sort explicitly)."""
    cols = [F.col(k) for k in keys] + list(order)
    return table.repartitionByRange(*cols).sortWithinPartitions(*cols)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str],
                         file_format: str = "parquet") -> None:
    """Replace only the partitions present in ``df`` (idempotent replays)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(file_format).save(path))


def _folder(spark: SparkSession, path: str):
    """(file system, path) on whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def partitions_of(spark: SparkSession, path: str, *columns: str) -> list[tuple[int, ...]]:
    """The integer values of the folders ``col=value/...`` under ``path``, from
    a listing alone; empty where there is no such path."""
    fs, root = _folder(spark, path)
    found = [((), root)] if fs.exists(root) else []
    for c in columns:
        found = [(v + (int(s.getPath().getName().split("=")[1]),), s.getPath()) for v, p in found
                 for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith(f"{c}=")]
    return sorted(v for v, _ in found)


def drop_partition(spark: SparkSession, path: str, **values: int) -> None:
    fs, p = _folder(spark, "/".join([path, *[f"{c}={v}" for c, v in values.items()]]))
    fs.delete(p, True)


#: Rows for which a new keyed table gets one more bucket, and its least number.
BUCKET_ROWS, LEAST_BUCKETS = 500_000, 8


def kept_number(spark: SparkSession, path: str, name: str) -> int | None:
    """A number that a table was made with, kept as the name of an empty folder
    ``name=number`` that readers pass over."""
    fs, root = _folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return next((int(n.split("=")[1]) for n in names if n.startswith(f"{name}=")), None)


def keep_number(spark: SparkSession, path: str, name: str, number: int) -> None:
    fs, marker = _folder(spark, f"{path}/{name}={number}")
    fs.mkdirs(marker)


def file_number(spark: SparkSession, path: str) -> int:
    """The number of data files directly under ``path``."""
    fs, root = _folder(spark, path)
    return sum(s.isFile() and s.getPath().getName().startswith("part-") for s in fs.listStatus(root)) \
        if fs.exists(root) else 0


def bucket_number(spark: SparkSession, path: str) -> int | None:
    """The number of buckets that a keyed table was made with."""
    return kept_number(spark, path, "_buckets")


def upsert_table(rows: DataFrame, path: str, keys: Sequence[str], version: Sequence[Column],
                 buckets: int | None = None) -> None:
    """Merge ``rows`` into the keyed table stored at ``path``: the greatest
    ``version`` per key wins, whether new or stored.

    The table is partitioned by a hash bucket of its keys; only buckets that
    ``rows`` touches are read and replaced.  Their number is settled by the
    first write (``buckets``, else by its rows) and kept with the table, so a
    later write with another number can't spread a key over two buckets.
    Buckets are replaced folder by folder: after a crash half-way some hold the
    new rows and some the old ones, and the same write again completes it.
    """
    spark = rows.sparkSession
    stored_number = bucket_number(spark, path)
    number = stored_number or buckets or max(LEAST_BUCKETS, -(-rows.count() // BUCKET_ROWS))
    if stored_number is None:
        keep_number(spark, path, "_buckets", number)
    new = rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(number)).cast("int"))
    if partitions_of(spark, path, "bucket"):
        stored = spark.read.parquet(path)
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most ``number``
        new = stored.filter(F.col("bucket").isin(touched)).unionByName(new)
    latest = upsert_latest(new, list(keys), version)
    overwrite_partitions(latest.repartition("bucket", *keys).sortWithinPartitions("bucket", *keys), path, ["bucket"])


# ---- compaction and expiry of (day, batch) stream sinks ---------------------

def _newest(pairs: list[tuple[int, ...]]) -> dict[int, int]:
    out: dict[int, int] = {}
    for day, number in pairs:
        out[day] = max(number, out.get(day, -1))
    return out


def read_compacted(spark: SparkSession, raw_path: str, compact_path: str | None = None,
                   days: Sequence[int] | None = None, schema: str | None = None) -> DataFrame:
    """A stream sink's rows, each once: for a compacted day its newest
    compacted copy plus the raw batches that came after it, for any other day
    all raw batches.  A late row of a compacted day is in a later batch, so
    nothing is hidden.  ``days`` prunes both sides; all filters are partition
    filters, built from folder listings (one entry per day).  A table whose
    days have all gone has no file to read columns from: with ``schema`` (its
    columns without day and batch) it reads as empty."""
    want = None if days is None else [int(d) for d in days]
    done = _newest(partitions_of(spark, compact_path, "day", "through")) if compact_path else {}
    if want is not None:
        done = {d: b for d, b in done.items() if d in want}
    if schema and not partitions_of(spark, raw_path, "day"):
        raw = spark.createDataFrame([], f"{schema}, batch int, day int")
    else:
        raw = spark.read.parquet(raw_path)
    if want is not None:
        raw = raw.filter(F.col("day").isin(want))
    if not done:
        return raw.drop("batch")
    later = ~F.col("day").isin(list(done))
    for day, through in done.items():
        later = later | ((F.col("day") == day) & (F.col("batch") > through))
    copies = F.lit(False)
    for day, through in done.items():
        copies = copies | ((F.col("day") == day) & (F.col("through") == through))
    compacted = spark.read.parquet(compact_path).filter(copies).drop("through")
    return compacted.unionByName(raw.filter(later).drop("batch"))


def compact_days(spark: SparkSession, raw_path: str, compact_path: str, days: Sequence[int],
                 sort_cols: Sequence[str]) -> None:
    """Rewrite ``days`` of a ``(day, batch)`` sink, with what was compacted of
    them before, as ``(day, through)``: ``through`` is the last batch inside.
    Range partitioning spreads a busy day over several files; running it again
    replaces the same folders."""
    newest = _newest(partitions_of(spark, raw_path, "day", "batch"))
    todo = {int(d): newest[int(d)] for d in days if int(d) in newest}
    if not todo:
        return
    through = F.element_at(F.create_map(*[F.lit(x) for kv in todo.items() for x in kv]), F.col("day").cast("int"))
    rows = read_compacted(spark, raw_path, compact_path, list(todo)).withColumn("through", through)
    overwrite_partitions(rows.repartitionByRange("day", *sort_cols).sortWithinPartitions("day", *sort_cols),
                         compact_path, ["day", "through"])


def expire_days(spark: SparkSession, paths: Sequence[str], before: int) -> list[int]:
    """Drop every ``day`` partition older than day ``before`` (yyyymmdd) from
    the tables; returns the days dropped."""
    gone = set()
    for path in paths:
        for (day,) in partitions_of(spark, path, "day"):
            if day < before:
                drop_partition(spark, path, day=day)
                gone.add(day)
    return sorted(gone)

"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadlens.session import scratch_path

#: A word: a run of bytes that are none of space, \t, \n, \v, \f, \r.
WORD = r"[^\x20\x09-\x0D]+"

#: A table is broadcast only after it was counted and found at most this long.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet under the shared folder of
    ``spark.checkpoint.dir`` and read it back.  A lost executor costs no
    recomputation, and readers get column pruning and true sizes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stash_round(df: DataFrame, name: str, paths: list[str]) -> DataFrame:
    """``stash`` for a job of many rounds: the rows of this and all earlier
    rounds, whose folders are in ``paths``.  The shuffle files of a round are
    removed once it is written, so the disk holds those of one round only."""
    spark = df.sparkSession
    paths.append(scratch_path(spark, name))
    with shuffles_released(spark):
        df.write.parquet(paths[-1])
    return spark.read.schema(df.schema).parquet(*paths)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries run inside remove their shuffle files as soon as they end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a stashed table of narrow rows: counting it reads only file
    footers) with a broadcast hint if it has at most ``max_rows`` rows; beyond
    that unhinted, and the join shuffles.  The rows joined are the same."""
    return F.broadcast(df) if df.count() <= max_rows else df


def id_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The document's name for hashing: its id, or a digest of its text where
    the id is null."""
    return F.coalesce(F.col(doc_id).cast("string"), F.md5(F.col(text)), F.lit(""))


def hash60(seed: str, key: Column) -> Column:
    """A 60-bit pseudo-random integer from (seed, key): the first 15 hex
    digits of the MD5, which DuckDB can compute as well."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key)), 1, 15), 16, 10).cast("long")


def bucket_count(rows: int, per_bucket: int = 20_000, least: int = 256) -> int:
    """How many hash ranges to cut ``rows`` rows into so that one range stays
    a bounded share of work.  Results never depend on this number."""
    return max(least, -(-rows // per_bucket))


def running_before(df: DataFrame, groups: Sequence[str], bucket: str, value: Column, name: str) -> DataFrame:
    """Per (groups, bucket): the sum of ``value`` over all earlier buckets of
    the group.  The sums are pre-aggregated before the shuffle, so the window
    sees one row per bucket however many rows a group has."""
    per = df.groupBy(*groups, bucket).agg(F.sum(value).alias("__in"))
    w = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*groups, bucket, F.coalesce(F.sum("__in").over(w), F.lit(0)).cast("long").alias(name))


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null equals null; the right side's keys go."""
    renamed = right.select([F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = [left[c].eqNullSafe(renamed[f"__r_{c}"]) for c in keys]
    return left.join(renamed, cond, how).drop(*[f"__r_{c}" for c in keys])


def broadcast_fields(spark: SparkSession, model: object):
    """Broadcast a model's fields as a plain tuple.  A broadcast is pickled by
    reference to its classes, which workers may not have; the tuple holds only
    built-in and numpy values, and a task makes the model again from it."""
    return spark.sparkContext.broadcast(tuple(vars(model).values()))


def text_score(setup: Callable[[], Callable[[pd.Series], np.ndarray]]) -> Callable[..., Column]:
    """A column function text -> double.  ``setup`` runs once in each task and
    gives a function over a batch of texts; batches are bounded by Spark's
    Arrow batch size, and other columns never leave the JVM."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = setup()
        for texts in batches:
            yield pd.Series(score(texts), dtype="float64")
    return run


def sliced_batches(batches: Iterator[pa.RecordBatch], rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches in views of at most ``rows`` rows, so that few of a
    batch's texts are Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))

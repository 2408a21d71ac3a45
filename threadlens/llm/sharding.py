"""Proportional stratified interleaving into shards.

Rows are shuffled by a seeded hash and ranked within their source; a row's
fractional rank (rank - 1/2) / (rows of its source) spreads every source evenly
over (0, 1).  Sorting all rows by fractional rank interleaves the sources in
proportion, and cutting that order into equal runs gives every shard the
mixture of the whole.

Both ranks are distributed: hash ranges (then ranges of the fractional rank)
are counted, the counts are summed over the ranges, and a window ranks rows
inside one range only.  No window ever holds a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.common import bucket_count, hash60, id_key, null_safe, running_before, small, stash

SHARDS = 16
SEED = "shard"


def interleaved(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes of the text plus 1),
    text_crc32, law ('rows': shard sizes differ by one row at most), shard,
    slot (0, 1, ... within the shard), grown_shard (null under this law), and
    the columns named in ``keep``.

    Defined cases: a null text has size 1 and the checksum of no bytes, 0; a
    null source is a stratum of its own, last in order; equal rows are ranked
    in any order, which gives the same rows; equal texts get no common shard,
    as counts that differ by one at most leave no room for that.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), hash60(seed, id_key()).alias("__h"),
        *[F.col(c).alias(f"__keep_{c}") for c in keep])
    rows = stash(rows, "shard-rows")
    total = rows.count()
    n = bucket_count(total)
    ties = ["__h", F.col("doc_id").asc_nulls_last(), "text_crc32", "size"]

    width = (1 << 60) // n + 1
    binned = rows.withColumn("__bin", F.floor(F.col("__h") / F.lit(width)).cast("long"))
    before = running_before(binned, ["source"], "__bin", F.lit(1), "__before")
    own = rows.groupBy("source").agg(F.count(F.lit(1)).alias("__rows"))
    own = own.withColumn("__turn", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())))
    bins = stash(null_safe(before, own, ["source"]), "shard-bins")
    place = F.row_number().over(Window.partitionBy("source", "__bin").orderBy(*ties))
    ranked = null_safe(binned, small(bins), ["source", "__bin"]) \
        .withColumn("__rank", F.col("__before") + place) \
        .withColumn("__frac", (F.col("__rank") * 2 - 1).cast("double") / (F.col("__rows") * 2).cast("double"))
    ranked = stash(ranked.drop("__bin", "__before", "__rank", "__rows")
                   .withColumn("__run", F.floor(F.col("__frac") * n).cast("long")), "shard-ranked")

    starts = stash(running_before(ranked, [], "__run", F.lit(1), "__start"), "shard-runs")
    at = F.row_number().over(Window.partitionBy("__run").orderBy("__frac", "__turn", *ties))
    placed = ranked.join(small(starts), "__run").withColumn("__at", F.col("__start") + at - 1)
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", F.expr(f"(__at * {shards}L) div {max(total, 1)}L").cast("int")) \
        .withColumn("slot", (F.col("__at") - first).cast("long")) \
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                F.lit(None).cast("int").alias("grown_shard"),
                *[F.col(f"__keep_{c}").alias(c) for c in keep])


ORACLE = r"""
WITH tab AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i, range(1, 9)),
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
b AS (
  SELECT doc_id, source, coalesce(text, '') AS text, coalesce(CAST(doc_id AS VARCHAR), md5(text), '') AS key
  FROM documents),
r AS (
  SELECT doc_id, source, strlen(text) + 1 AS size,
         CAST('0x' || substr(md5('shard|' || key), 1, 15) AS BIGINT) AS h,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
             lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1]))) AS text_crc32
  FROM b, tab),
k AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS LAST, text_crc32, size) AS rank,
         count(*) OVER (PARTITION BY source) AS n FROM r),
p AS (
  SELECT *, row_number() OVER (ORDER BY (rank * 2 - 1)::DOUBLE / (n * 2)::DOUBLE, source NULLS LAST, h,
                               doc_id NULLS LAST, text_crc32, size) - 1 AS pos,
         count(*) OVER () AS total FROM k)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(pos * 16 // total AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY pos * 16 // total ORDER BY pos) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM p"""

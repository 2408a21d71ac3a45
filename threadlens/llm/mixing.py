"""Mixing sources to target weights by capped water-filling.

Weights are shares of a word budget.  A source whose share would pass ``cap``
epochs of its own words is clamped there, and what it cannot take goes to the
others in proportion to their weights, until no share is above its cap.  Each
source is then sampled: ``floor(epochs)`` whole repetitions of every document
and one seeded partial repetition for the rest.

The partial repetition takes documents in the order of a seeded hash up to the
words still wanted.  Its end is found with two histogram steps (hash ranges,
then the one range that holds the end), so a source of any size is never
sorted in one task, and one (hash, id) pair per source decides every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.common import WORD, bucket_count, hash60, id_key, null_safe, running_before, small, stash

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2.0
SEED = "mix"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def water_filling(sources: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
                  cap: float = CAP) -> DataFrame:
    """Add ``target`` (double) to (source, source_size), one row per source.

    Sources in code-point order, null last, take ``weights`` in turn.  Sorted
    by size per weight, the clamped sources are a prefix; with the words and
    weights of that prefix known, the level of the others is one division.
    Both windows see one row per source.
    """
    one = Window.partitionBy(F.lit(0))
    turn = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("turn", turn).withColumn("weight", w) \
        .withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    order = one.orderBy(F.col("source_size") / F.col("weight"), "turn")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = ranked \
        .withColumn("words", F.sum("source_size").over(one) * F.lit(float(budget))) \
        .withColumn("rest", F.col("words") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) \
        .withColumn("open", F.sum("weight").over(after)) \
        .withColumn("free", F.col("weight") * F.col("rest") / F.col("open") < F.col("limit"))
    first = F.struct(F.when(F.col("free"), 0).otherwise(1), F.col("source_size") / F.col("weight"), "turn",
                     F.col("rest").alias("rest"), F.col("open").alias("open"))
    return level.withColumn("at", F.min(first).over(one)).select(
        "source", "source_size",
        F.coalesce(F.least("limit", F.col("weight") * F.col("at.rest") / F.col("at.open")), F.lit(0.0))
        .alias("target"))


def _until(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """(source, cut_h, cut_key): the last document of each source's partial
    repetition, null where it takes none."""
    n = bucket_count(rows.count())
    width = (1 << 60) // n + 1
    binned = rows.withColumn("bucket", F.floor(F.col("h") / F.lit(width)).cast("long"))
    sums = binned.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = running_before(binned, ["source"], "bucket", F.col("size"), "before")
    ends = null_safe(null_safe(before, sums, ["source", "bucket"]), plan, ["source"]) \
        .filter((F.col("before") < F.col("part"))) \
        .groupBy("source").agg(F.max(F.struct("bucket", "before", "part")).alias("e")) \
        .select("source", F.col("e.bucket").alias("bucket"), F.col("e.before").alias("before"),
                F.col("e.part").alias("part"))
    inside = null_safe(binned, small(stash(ends, "mix-ends")), ["source", "bucket"])
    # equal (hash, key) rows are one step: a RANGE frame adds them together
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("h", "key"))
    own = F.sum("size").over(Window.partitionBy("source", "h", "key"))
    middle = F.col("before") + F.col("upto") - F.col("own") / 2
    last = inside.withColumn("upto", upto).withColumn("own", own).filter(middle < F.col("part")) \
        .groupBy("source").agg(F.max(F.struct("h", "key")).alias("c"))
    # nothing of the last range fits: everything in the earlier ranges does
    edge = ends.select("source", (F.col("bucket") * width - 1).alias("edge"))
    return null_safe(edge, last, ["source"], "left").select(
        "source", F.coalesce("c.h", "edge").alias("cut_h"), F.coalesce("c.key", F.lit("")).alias("cut_key"))


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, cap: float = CAP,
             seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(narrow rows, plan): rows (doc_id, source, key, size, h) of ``docs`` and
    one plan row per source: source_size, target, whole, cut_h, cut_key."""
    rows = docs.select("doc_id", "source", id_key().alias("key"), word_count().alias("size"),
                       hash60(seed, id_key()).alias("h"))
    rows = stash(rows, "mix-rows")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = water_filling(sources, weights, budget, cap) \
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                    .otherwise(0).cast("long")) \
        .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = stash(plan, "mix-plan")
    return rows, stash(null_safe(plan, _until(rows, plan, seed), ["source"], "left"), "mix-cuts")


def copies() -> Column:
    """Repetitions of a row that has h and key, given its source's plan."""
    inside = (F.col("h") < F.col("cut_h")) | ((F.col("h") == F.col("cut_h")) & (F.col("key") <= F.col("cut_key")))
    return F.col("whole") + F.when(inside, 1).otherwise(0)


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size (words), source_size, target (of its
    source), taken (words the mix takes, repetitions counted), copies.

    Defined cases: a null text has size 0 (and is repeated like any other); a
    null source is a source of its own, last in order; rows of one id are taken
    together; a null id is named by its text; an empty table gives no rows.
    """
    rows, plan = mix_plan(docs, **options)
    return null_safe(rows, small(plan), ["source"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies()).cast("long").alias("taken"),
        copies().cast("long").alias("copies"))


def mixed(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as the mix takes it,
    with its columns as they were.  The plan has one row per source, so the
    rows with texts are neither shuffled nor sorted while the plan is small."""
    _, plan = mix_plan(docs, seed=seed, **options)
    plan = plan.select(F.col("source").alias("__source"), "whole", "cut_h", "cut_key") \
        .select(*[F.col(c).alias(c if c == "__source" else f"__{c}") for c in ("__source", "whole", "cut_h", "cut_key")])
    here = docs.withColumns({"__h": hash60(seed, id_key()), "__key": id_key()})
    joined = here.join(small(stash(plan, "mix-decisions")), F.col("source").eqNullSafe(F.col("__source")))
    inside = (F.col("__h") < F.col("__cut_h")) | \
        ((F.col("__h") == F.col("__cut_h")) & (F.col("__key") <= F.col("__cut_key")))
    n = (F.col("__whole") + F.when(inside, 1).otherwise(0)).cast("int")
    return joined.withColumn("__copy", F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array()))) \
        .select(*docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         coalesce(CAST(doc_id AS VARCHAR), md5(text), '') AS key FROM documents),
h AS (SELECT *, CAST('0x' || substr(md5('mix|' || key), 1, 15) AS BIGINT) AS h FROM d),
s AS (SELECT source, sum(size) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM h GROUP BY source),
w AS (SELECT *, CASE turn % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
               - coalesce(sum(cap) OVER (ORDER BY source_size / weight, turn
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER (ORDER BY source_size / weight, turn
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w),
f AS (SELECT rest, open FROM l WHERE weight * rest / open < cap ORDER BY source_size / weight, turn LIMIT 1),
t AS (SELECT source, source_size, least(cap, weight * (SELECT rest FROM f) / (SELECT open FROM f)) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r AS (SELECT h.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS part,
             sum(size) OVER (PARTITION BY h.source ORDER BY h, key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               - (sum(size) OVER (PARTITION BY h.source, h, key)) / 2.0::DOUBLE AS middle
      FROM h JOIN p ON h.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (whole + CASE WHEN middle < part THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       CAST(whole + CASE WHEN middle < part THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM r"""

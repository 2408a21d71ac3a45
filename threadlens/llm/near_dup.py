"""MinHash near-dedup with bottom-k sketches from one hash function.

1. Each text becomes its set of 5-word shingles; the ``k`` smallest hash values
   of one hash function are its sketch.  Documents with equal sets form a
   class, and one representative (the smallest id) goes on: thousands of exact
   copies cost one row.
2. Inverted lists of retained values generate candidates.  Two sets with
   Jaccard >= 0.75 share at least ``need`` retained values (exactly so while
   every partner's sketch is its whole set, else with odds of about 6e-9 of a
   miss), so they share one of the ``size - need + 1`` rarest values of either
   sketch: only those are listed, and a passage that many documents share
   stays out of the lists.
3. A list of at most ``list_limit`` members gives all its pairs.  A longer one
   gives the pairs of each member with the list's centre (linear in its
   length); its members then go through step 5, so nothing is cut off.
4. The union-sketch estimate drops pairs far below the threshold (one at
   exactly 0.75 with odds of about 6e-9), and the exact Jaccard of the full
   sets confirms the rest.
5. Members of long lists that are still in different components are joined
   again on inverted lists of their *full* sets (the sketch with k = all),
   under the exact prefix bound, and confirmed in the same way.
6. Large-star / small-star contraction labels the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.common import null_safe, small, stash
from threadlens.llm.shingles import WordHashes, shingle_set

SKETCH = 64
LIST_LIMIT = 64
#: Standard deviations allowed for the sketch's sampling error.
MARGIN_OVERLAP = 6.0
MARGIN_ESTIMATE = 6.0


def required_overlap(size: Column, k: int, percent: int) -> Column:
    """Retained values that a sketch over a set of ``size`` shingles shares
    with the sketch of any set at or above the threshold."""
    j = percent / 100.0
    sampled = math.floor(k * j - MARGIN_OVERLAP * math.sqrt(k * j * (1 - j)))
    whole = F.ceil(size * F.lit(percent) / F.lit(100))
    return F.when(size <= math.floor(k * j), whole).otherwise(F.lit(max(1, sampled))).cast("int")


def signatures(docs: DataFrame, k: int = SKETCH) -> DataFrame:
    """doc_id, text_key (digest of the text), n_shingles, set_key (128-bit digest
    of the set; null when it is empty), sketch (ascending)."""
    schema = "doc_id long, text_key string, n_shingles long, set_key string, sketch array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, sketches = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), hashes)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                sketches.append(s[:k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.string()), pa.array(sketches, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_shingles", "set_key", "sketch"])

    return _keyed(docs).mapInArrow(run, schema)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, text_key): ids may repeat or be null, so a row is named by
    its id and the digest of its text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.md5(text).alias("text_key"))


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, shingles) of the classes in ``ids`` (rep, doc_id, text_key): the
    text of the one row that stands for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), hashes) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["rep", "shingles"])

    rows = null_safe(_keyed(docs), small(ids.select("rep", "doc_id", "text_key")), ["doc_id", "text_key"])
    # a repeated row gives its set again
    return rows.select("rep", "text").mapInArrow(run, "rep long, shingles array<long>").dropDuplicates(["rep"])


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def list_pairs(lists: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(candidate pairs a < b, members of long lists) from inverted lists with
    rows (value, n, rep, size, shared)."""
    short = lists.filter(F.col("n") <= limit).select("value", "rep", "size")
    other = short.select("value", F.col("rep").alias("rep2"), F.col("size").alias("size2"))
    near_size = F.lit(100) * F.least("size", "size2") >= F.lit(75) * F.greatest("size", "size2")
    inside = short.join(other, "value").filter((F.col("rep") < F.col("rep2")) & near_size) \
        .select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
    long = lists.filter(F.col("n") > limit)
    # the member with most shared values stands nearest the middle of a group
    centres = long.groupBy("value").agg(F.max(F.struct("shared", -F.col("rep"))).alias("c")) \
        .select("value", (-F.col("c.col2")).alias("centre"))
    # one row per long list: broadcast while they are few, so that no task gets a whole list
    stars = long.join(small(stash(centres, "centres")), "value").filter(F.col("rep") != F.col("centre")).select(*_pair("rep", "centre"))
    return inside.union(stars).distinct(), long.select("rep").distinct()


def inverted_lists(reps: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows (value, n, rep, size, shared): for each representative the rarest
    values of its sketch that some other one retains too, as many as the
    overlap bound asks for."""
    postings = reps.select("rep", F.explode("sketch").alias("value"))
    counts = postings.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = postings.join(counts, "value")
    sizes = reps.select("rep", F.col("n_shingles").alias("size"), F.size("sketch").alias("kept"))
    by_rep = Window.partitionBy("rep")
    return (shared.join(sizes, "rep")
            .withColumn("shared", F.count(F.lit(1)).over(by_rep))
            .withColumn("place", F.row_number().over(by_rep.orderBy("n", "value")) + F.col("kept") - F.col("shared"))
            .filter(F.col("place") <= F.col("kept") - required_overlap(F.col("size"), k, percent) + 1)
            .select("value", "n", "rep", "size", "shared"))


def estimated(pairs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose union-sketch estimate (shared values among the ``k``
    smallest of both sketches) may belong to a Jaccard at the threshold."""
    ids = stash(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "sketch-ids")
    sk = stash(reps.select("rep", "sketch").join(small(ids), "rep", "left_semi"), "sketches")
    both = pairs.join(sk.select(F.col("rep").alias("a"), F.col("sketch").alias("sa")), "a") \
        .join(sk.select(F.col("rep").alias("b"), F.col("sketch").alias("sb")), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    j = percent / 100.0
    scored = both.withColumn("u", union).select(
        "a", "b", F.size("u").alias("n"),
        F.size(F.array_intersect(F.array_intersect("sa", "sb"), "u")).alias("x"))
    slack = F.lit(MARGIN_ESTIMATE * math.sqrt(j * (1 - j))) * F.sqrt("n")
    return scored.filter(F.col("x") >= F.floor(F.col("n") * j - slack)).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose exact Jaccard over full sets reaches the threshold."""
    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a") \
        .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
    x = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", x.alias("x"), (F.size("sa") + F.size("sb")).alias("t")) \
        .filter(F.col("x") * 100 >= F.lit(percent) * (F.col("t") - F.col("x"))).select("a", "b")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (a, b), by
    alternating large-star and small-star steps until only stars are left.
    Every step moves edges towards smaller ids and keeps connectivity; each
    round is written to the shared folder."""
    e = stash(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .filter("u <> v").distinct(), name)
    while True:
        sym = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        big = sym.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u <> v").distinct()
        low2 = big.groupBy("u").agg(F.min("v").alias("m"))
        new = stash(big.join(low2, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct(), name)
        e = new
        if new.join(new.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty() \
                and new.groupBy("u").count().filter("count > 1").isEmpty():
            break
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")) \
        .union(roots.select("node", F.col("node").alias("label")))


def far_links(members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between members of long lists in different components, from
    inverted lists over their full sets.

    A link needs one common value among the ``size - ceil(0.75 size) + 1``
    rarest of either set, and values that nobody else has bound the overlap.
    For each value the rows of its largest component stay on one side only, so
    a group that is already one component costs nothing."""
    own = members.join(sets, "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("rep", F.coalesce("label", "rep").alias("label"), F.size("shingles").alias("size"), "shingles")
    postings = own.select("rep", "label", "size", F.explode("shingles").alias("value"))
    counts = postings.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    by_rep = Window.partitionBy("rep")
    prefix = (postings.join(counts, "value")
              .withColumn("shared", F.count(F.lit(1)).over(by_rep))
              .withColumn("place", F.row_number().over(by_rep.orderBy("n", "value"))
                          + F.col("size") - F.col("shared"))
              .filter(F.col("place") <= F.col("size") - F.ceil(F.col("size") * percent / 100) + 1)
              .select("value", "rep", "label", "size", "shared", (F.col("size") - F.col("place")).alias("behind")))
    prefix = stash(prefix, "long-lists")
    major = prefix.groupBy("value", "label").agg(F.count(F.lit(1)).alias("c")) \
        .groupBy("value").agg(F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("labels")) \
        .filter("labels > 1").select("value", F.col("top.label").alias("major"))
    # one row per value, then the rows outside the largest component: broadcast while few,
    # so that a value held by a whole group is not dealt to one task
    major = small(stash(major, "majors"))
    left = small(stash(prefix.join(major, "value").filter(F.col("label") != F.col("major")).drop("major"), "minor"))
    right = prefix.select("value", *[F.col(c).alias(c + "2") for c in ("rep", "label", "size", "shared", "behind")])
    common = F.least("shared", "shared2")
    # values stand in one order in all sets, so the first common value of a
    # link has room behind it, in both sets, for the rest of the overlap
    overlap = F.ceil((F.col("size") + F.col("size2")) * percent / (100 + percent))
    pairs = right.join(left, "value").filter(
        (F.col("label") != F.col("label2"))
        & (F.least("behind", "behind2") + 1 >= overlap)
        & (F.lit(100) * F.least("size", "size2") >= F.lit(percent) * F.greatest("size", "size2"))
        & (F.lit(100) * common >= F.lit(percent) * (F.col("size") + F.col("size2") - common))) \
        .select(*_pair("rep", "rep2")).distinct()
    return confirmed(stash(pairs, "far-pairs"), sets, percent)


def _stand_in() -> Column:
    """The row that stands for a group: the smallest id (null last), then text digest."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))


def classified(docs: DataFrame, percent: int = 75, k: int = SKETCH, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Every row of ``docs`` as (doc_id, text_key, n_shingles, label,
    component_id): rows of one label are linked, directly or over others, and
    component_id is the smallest id among them; a row without words has neither.

    Equal shingle sets form a class, which is searched once.  Classes are
    numbered, so neither repeated nor null ids stand for anything here.
    """
    sig = stash(signatures(docs, k), "signatures")
    classes = stash(sig.filter("set_key IS NOT NULL").groupBy("set_key").agg(_stand_in().alias("row"))
                    .select("set_key", "row.doc_id", "row.text_key"), "class-rows")
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_key")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # numbers follow the ids, so that ties between centres go to the smallest id
    classes = stash(classes.repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .withColumn("rep", F.monotonically_increasing_id()), "classes")
    # any row of a class has its sketch: dealt by class once, copies joined before
    reps = sig.filter("set_key IS NOT NULL").select("set_key", "n_shingles", "sketch").dropDuplicates(["set_key"]) \
        .join(classes.select("set_key", "rep"), "set_key").select("rep", "n_shingles", "sketch")
    reps = stash(reps, "representatives")
    lists = stash(inverted_lists(reps, k, percent), "lists")
    pairs, long = list_pairs(lists, list_limit)
    pairs = stash(estimated(stash(pairs, "pairs"), reps, k, percent), "likely-pairs")
    long = stash(long, "long-members")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).union(long).distinct()
    ids = stash(ids.join(classes.select("rep", "doc_id", "text_key"), "rep"), "set-ids")
    sets = stash(full_sets(docs, ids), "sets")
    edges = stash(confirmed(pairs, sets, percent), "links")
    labels = components(edges)
    if not long.isEmpty():
        more = stash(far_links(long, sets, stash(labels, "labels"), percent), "far-links")
        if not more.isEmpty():
            labels = components(edges.union(more))
    moved = labels.filter("node <> label").withColumnRenamed("node", "rep")
    found = stash(classes.join(moved, "rep", "left").select("set_key", "doc_id", F.coalesce("label", "rep").alias("label")),
                  "class-labels")
    found = found.join(found.groupBy("label").agg(F.min("doc_id").alias("component_id")), "label").drop("doc_id")
    return sig.select("doc_id", "text_key", "n_shingles", "set_key").join(found, "set_key", "left").drop("set_key")


def near_duplicates(docs: DataFrame, percent: int = 75, k: int = SKETCH,
                    list_limit: int = LIST_LIMIT) -> DataFrame:
    """Link documents whose 5-word shingle sets have Jaccard >= percent / 100.

    Returns one row per row of ``docs``: doc_id, n_shingles, component_id (the
    smallest doc_id reachable over links, itself included), kept (doc_id =
    component_id).

    Defined cases: a null or blank text has the empty set and no links; rows of
    one id with several texts are linked each by its own text; a row with a null
    id is linked like any other, takes the smallest id of its component, or a
    null one where all ids are null, and is kept only in the latter case.  Extra
    columns are ignored.
    """
    own = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return classified(docs, percent, k, list_limit).select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(
        F.col("doc_id") == own, own.isNull()).alias("kept"))


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates, with its columns:
    the one of the smallest id (null last; of several texts of that id the one
    of the smallest digest).  Rows without words stay; of several rows with one
    id and text one stays."""
    rows = stash(classified(docs, **options), "classified")
    linked = rows.filter("label IS NOT NULL")
    stays = linked.groupBy("label").agg(_stand_in().alias("row")).select(
        "label", F.col("row.doc_id").alias("__id"), F.col("row.text_key").alias("__text"))
    gone = linked.join(stays, "label").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__text"))))
    gone = stash(gone.select("doc_id", "text_key").distinct(), "duplicates")
    again = stash(rows.groupBy("doc_id", "text_key").count().filter("count > 1").select("doc_id", "text_key")
                  .subtract(gone), "repeated")
    if again.isEmpty():
        return _named(docs, gone, "left_anti")
    # only rows that are repeated are shuffled with their texts
    return _named(docs, stash(gone.union(again), "set-aside"), "left_anti").union(
        _named(docs, again, "left_semi").dropDuplicates(["doc_id", "text"]))


def _named(docs: DataFrame, names: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text_key) is among ``names`` or, by
    ``left_anti``, is not."""
    names = small(names.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text")))
    return docs.join(names, F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
                     & F.md5(F.col("text").cast("string")).eqNullSafe(F.col("__text")), how)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 OR words IS NULL THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')) END) AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT s.doc_id, s.sh, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
      FROM s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.sh)"""

"""Prefix trie of conversations from sorted turn-id matrices.

Conversations become rows of turn ids, ``WIDTH`` turns to a row (a *panel*;
longer conversations have several).  All rows are sorted by a range partition
and cut into blocks of ``BLOCK`` rows.  In a block the ids form a padded
matrix: a lexsort orders it, the columns' change masks, OR-accumulated from the
left, mark where a node starts, and ``reduceat`` sums every depth.  Each block
also gets the row before and the row after it, so that every node starts once;
nodes that reach over a block's edge are summed over the blocks by their key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.common import small, stash

#: Turns in a row of the matrix.
WIDTH = 64
#: Rows of a block, a power of two (2^12).
BLOCK_BITS = 12
#: The stride of conversations that share a first part, and most turns shared.
STRIDE, MOST_SHARED = 100, 5

#: monotonically_increasing_id() is the partition's number times 2^33 plus the row's.
PART_BITS = 33


def _numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` sorted over the whole cluster, with ``mid``: a number that rises
    in that order.  A range partition splits a hot key by what follows it."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stash(ordered.withColumn("mid", F.monotonically_increasing_id()), name)


def _digest(value: Column) -> Column:
    """128 bits of a SHA-256, as 32 hex digits."""
    return F.substring(F.sha2(value, 256), 1, 32)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, said, chars): a digest in place of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return conversations.filter(F.col("conv_id").isNotNull()) \
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), said.alias("said"),
                F.length(text).cast("long").alias("chars"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, pos, said, chars) of every rebuilt turn, (conv_id) of all
    conversations).  Turns are counted within range partitions, so one
    conversation may be longer than a task can hold."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("said")]
    turns = _numbered(turns_of(conversations), order, "trie-turns") \
        .withColumn("part", F.shiftright("mid", PART_BITS))
    own = Window.partitionBy("conv_id")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)
    parts = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("mid").alias("first")) \
        .withColumn("before", F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("total", F.sum("n").over(own)) \
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % STRIDE).withColumn("h", shared)
    bases = parts.filter((F.col("conv_id") == F.col("base")) & (F.col("before") == 0)) \
        .select("base", F.col("total").alias("base_turns"))
    parts = stash(parts.join(bases, "base", "left").withColumn("lead", F.least(
        "h", F.coalesce("base_turns", F.lit(0)))).drop("n", "total", "base_turns"), "trie-parts")
    is_base = F.col("conv_id") == F.col("base")
    placed = turns.join(parts, ["conv_id", "part"]) \
        .withColumn("k", F.col("mid") - F.col("first") + F.col("before") + 1)
    kept = placed.filter(is_base | (F.col("k") > F.col("h"))) \
        .select("conv_id", F.when(is_base, F.col("k")).otherwise(F.col("lead") + F.col("k") - F.col("h")).alias("pos"),
                "said", "chars")
    heads = placed.filter(is_base & (F.col("k") <= MOST_SHARED)) \
        .select("base", F.col("k").alias("pos"), "said", "chars")
    convs = parts.filter(F.col("before") == 0)
    led = convs.filter(~is_base).select("conv_id", "base", "h").join(heads, "base") \
        .filter(F.col("pos") <= F.col("h")).select("conv_id", "pos", "said", "chars")
    return kept.unionByName(led), convs.select("conv_id")


def panels(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(panel, px, py, ids, goes_on, conv_id, chars): a row per conversation and
    ``WIDTH`` turns.  ids are 16 bytes a turn; (px, py) name the turns before the
    panel (the XOR of digests of place and turn)."""
    cell = _digest(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("said")))
    half = [F.conv(F.substring("cell", at, 16), 16, -10).cast("long") for at in (1, 17)]
    rows = turns.withColumn("cell", cell).withColumn("panel", F.floor((F.col("pos") - 1) / WIDTH).cast("int")) \
        .groupBy("conv_id", "panel").agg(
            F.sort_array(F.collect_list(F.struct("pos", "cell", "chars"))).alias("turns"),
            F.bit_xor(half[0]).alias("x"), F.bit_xor(half[1]).alias("y"))
    along = Window.partitionBy("conv_id").orderBy("panel")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "panel", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"p{c}") for c in ("x", "y")],
        F.unhex(F.array_join("turns.cell", "")).alias("ids"), F.lead("panel").over(along).isNotNull().alias("goes_on"),
        "conv_id", F.col("turns.chars").alias("chars"))
    none = convs.join(rows.filter("panel = 0").select("conv_id"), "conv_id", "left_anti").select(
        F.lit(0).alias("panel"), F.lit(0).cast("long").alias("px"), F.lit(0).cast("long").alias("py"),
        F.lit(b"").alias("ids"), F.lit(False).alias("goes_on"), "conv_id", F.array().cast("array<long>").alias("chars"))
    return stash(rows.unionByName(none), "trie-panels")


ORDER = ["panel", "px", "py", "ids", "goes_on", "conv_id"]


def blocks(rows: DataFrame) -> DataFrame:
    """``rows`` with ``block`` and ``role`` (0 the block's own, -1 the row before
    it, 1 the row after it)."""
    rows = _numbered(rows, [F.col(c) for c in ORDER], "trie-sorted").withColumn("part", F.shiftright("mid", PART_BITS)) \
        .withColumn("at", F.col("mid").bitwiseAND(F.lit((1 << PART_BITS) - 1)))
    every = Window.orderBy("part")  # one row per partition of the sort
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", "n", F.lag("part").over(every).alias("part_before"), F.lag("n").over(every).alias("n_before"),
        F.lead("part").over(every).alias("part_after"))
    size = 1 << BLOCK_BITS

    def block(part: str, at: Column) -> Column:
        return F.shiftleft(F.col(part), PART_BITS - BLOCK_BITS) + F.floor(at / size).cast("long")
    at, own = F.col("at"), block("part", F.col("at"))
    before = F.when(at > 0, own - 1).otherwise(block("part_before", F.col("n_before") - 1))
    after = F.when(at < F.col("n") - 1, own + 1).otherwise(block("part_after", F.lit(0)))

    def to(block: Column, role: int, when: Column) -> Column:
        return F.when(when & block.isNotNull(), F.struct(block.alias("block"), F.lit(role).alias("role")))
    places = F.array(to(own, 0, F.lit(True)), to(before, 1, at % size == 0),
                     to(after, -1, (at % size == size - 1) | (at == F.col("n") - 1)))
    return rows.join(F.broadcast(parts), "part") \
        .withColumn("to", F.explode(F.filter(places, lambda p: p.isNotNull()))) \
        .select("to.block", "to.role", *ORDER, "chars")


class Block:
    """The sorted matrix of a block and its masks."""

    def __init__(self, table: pa.Table):
        role = table["role"].to_numpy()
        panel, px, py, conv = (table[c].to_numpy().astype(np.int64) for c in ("panel", "px", "py", "conv_id"))
        goes_on = table["goes_on"].to_numpy(zero_copy_only=False).astype(bool)
        cells = table["ids"].to_pylist()
        length = np.array([len(c) // 16 for c in cells], np.int64)
        halves = np.frombuffer(b"".join(cells), ">u8").astype(np.uint64).reshape(-1, 2)
        row = np.repeat(np.arange(len(cells)), length)
        column = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        width = int(length.max(initial=0))
        ids = np.zeros((len(cells), width), np.int64)  # padded with 0, before every turn id
        by_id = np.lexsort((halves[:, 1], halves[:, 0]))
        new = np.ones(len(by_id), bool)
        new[1:] = (halves[by_id[1:]] != halves[by_id[:-1]]).any(1)
        number = np.empty(len(by_id), np.int64)
        number[by_id] = np.cumsum(new)
        ids[row, column] = number
        chars = np.zeros((len(cells), width), np.int64)
        chars[row, column] = table["chars"].combine_chunks().flatten().to_numpy()
        xor = np.zeros((len(cells), width + 1, 2), np.uint64)
        xor[row, column + 1] = halves
        xor[:, 0, 0], xor[:, 0, 1] = px.astype(np.uint64), py.astype(np.uint64)

        order = np.lexsort((conv, goes_on, *ids.T[::-1], py, px, panel, role))
        before, after = int((role < 0).sum()), int((role > 0).sum())
        panel, px, py, ids = panel[order], px[order], py[order], ids[order]
        changed = np.ones((len(order), width + 1), bool)
        changed[1:, 0] = (panel[1:] != panel[:-1]) | (px[1:] != px[:-1]) | (py[1:] != py[:-1])
        changed[1:, 1:] = ids[1:] != ids[:-1]
        starts = np.logical_or.accumulate(changed, axis=1)
        own = slice(before, len(order) - after)
        self.rows = order[own]
        self.panel, self.length, self.conv, self.goes_on = panel[own], length[self.rows], conv[self.rows], goes_on[self.rows]
        self.xor = np.bitwise_xor.accumulate(xor[self.rows], axis=1)
        self.starts, self.width = starts[own], width
        self.after = starts[-1] if after else np.ones(width + 1, bool)
        following = np.concatenate([self.starts[1:], self.after[None]])
        self.leaf = ~self.goes_on & following[np.arange(len(self.rows)), self.length]
        self.saved = np.where(self.starts[:, 1:], 0, chars[self.rows])


def _per_row(table: pa.Table) -> pa.Table:
    """What the panel before needs of each row."""
    b = Block(table)
    return pa.table({"conv_id": b.conv, "panel": b.panel.astype(np.int32), "saved": b.saved.sum(1),
                     "leaf": b.leaf, "first": b.starts[:, 1]})


NODES = ("conv_id long, depth long, parent long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends string, chunk string, block long, open boolean, kx long, ky long, pkx long, pky long")


def _nodes(table: pa.Table) -> pa.Table:
    """A block's nodes: whole ones with the hash of their ends, open ones (which
    another block or panel continues) with their key and their ends as text."""
    b = Block(table)
    saved_below, leaf_below, first_below = (table[c].to_numpy(zero_copy_only=False)[b.rows]
                                            for c in ("saved_below", "leaf_below", "first_below"))
    n, width = len(b.rows), b.width
    saved = np.zeros((n, width + 1), np.int64)
    saved[:, 1:] = np.cumsum(b.saved[:, ::-1], 1)[:, ::-1]
    saved[:, 0] = b.saved.sum(1)
    saved += saved_below[:, None]
    leaves = (b.leaf | leaf_below.astype(bool)).astype(np.int64)
    names = list(map(str, b.conv.tolist()))
    out: dict[str, list] = {f.split()[0]: [] for f in NODES.split(", ")}
    block = table["block"][0].as_py()
    parent_of, parent_open, parent_conv = None, None, None
    for d in range(width + 1):
        there = np.flatnonzero((b.length >= d) & ((b.panel == 0) | (d > 0)))
        if not len(there):
            parent_of = np.full(n, -1)
            parent_open, parent_conv = np.empty(0, bool), np.empty(0, np.int64)
            continue
        starts = b.starts[there, d].copy()
        goes_back = not starts[0]
        starts[0] = True
        at = np.flatnonzero(starts)
        ends_here = (b.length[there] == d) & ~b.goes_on[there]
        child = np.zeros(len(there), bool)
        if d < width:
            child = b.starts[there, d + 1] & (b.length[there] > d)
        deeper = (b.length[there] == d) & b.goes_on[there]
        child |= deeper & first_below[there].astype(bool)
        total = [np.add.reduceat(x.astype(np.int64), at) for x in (np.ones(len(there)), child, leaves[there],
                                                                  saved[there, d], ends_here, deeper)]
        convs = np.minimum.reduceat(b.conv[there], at)
        is_open = total[5] > 0
        is_open[0] |= goes_back
        if there[-1] == n - 1:
            is_open[-1] |= not b.after[d]
        head, node_of = there[at], np.full(n, -1)
        node_of[there] = np.cumsum(starts) - 1
        outside = (d == 1) & (b.panel[head] > 0)  # the parent is in the panel before
        if d == 0:
            parent, by_key = [None] * len(at), np.zeros(len(at), bool)
        else:
            up = parent_of[head]
            by_key = outside | (up >= 0) & parent_open[np.maximum(up, 0)] if len(parent_open) else outside
            parent = [None if k else int(parent_conv[u]) for k, u in zip(by_key, up)]
        keys = b.xor[head].astype(np.int64)
        for name, values in zip(("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"),
                                (convs, b.panel[head] * WIDTH + d, *total[:4])):
            out[name] += values.tolist()
        out["parent"] += parent
        out["open"] += is_open.tolist()
        out["block"] += [block] * len(at)
        for name, values, use in (("kx", keys[:, d, 0], is_open), ("ky", keys[:, d, 1], is_open),
                                  ("pkx", keys[:, d - 1, 0], by_key), ("pky", keys[:, d - 1, 1], by_key)):
            out[name] += [v if u else None for v, u in zip(values.tolist(), use)]
        for first, count, still in zip(head.tolist(), total[4].tolist(), is_open.tolist()):
            text = ",".join(names[first:first + count])
            out["chunk"].append(text if still else None)
            out["ends"].append(None if still else hashlib.sha256(text.encode()).hexdigest())
        parent_of, parent_open, parent_conv = node_of, is_open, convs
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.table({f.split()[0]: pa.array(out[f.split()[0]], kinds[f.split()[1]]) for f in NODES.split(", ")})


KEY = ["kx", "ky", "depth"]


def _open_ends(opened: DataFrame) -> DataFrame:
    """The hash of each open node's ends: its blocks' texts stream past in
    order, so a node's ids are never held together."""
    schema = "kx long, ky long, depth long, ends string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, digest, begun = None, None, False

        def closed():
            return pa.RecordBatch.from_pylist([dict(zip(KEY, here), ends=digest.hexdigest())], schema=pa.schema(
                [*[(c, pa.int64()) for c in KEY], ("ends", pa.string())]))
        for batch in batches:
            for *key, chunk in zip(*(batch.column(c).to_pylist() for c in (*KEY, "chunk"))):
                if key != here:
                    if here is not None:
                        yield closed()
                    here, digest, begun = key, hashlib.sha256(), False
                if chunk:
                    digest.update(("," * begun + chunk).encode())
                    begun = True
        if here is not None:
            yield closed()
    return opened.select(*KEY, "block", "chunk").repartition(*KEY).sortWithinPartitions(*KEY, "block").mapInArrow(run, schema)


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv_id, pos, said, chars) sequences; ``convs``
    names all conversations, those without turns too."""
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    rows = blocks(panels(turns, convs))
    deep = rows.filter("panel > 0")
    none = [F.lit(0).cast("long").alias("saved_below"), F.lit(False).alias("leaf_below"), F.lit(False).alias("first_below")]
    if deep.isEmpty():
        rows = rows.select("*", *none)
    else:
        found = deep.groupBy("block").applyInArrow(_per_row, "conv_id long, panel int, saved long, leaf boolean, first boolean")
        down = Window.partitionBy("conv_id").orderBy(F.desc("panel")).rowsBetween(Window.unboundedPreceding, 0)
        found = found.select("conv_id", (F.col("panel") - 1).alias("panel"), F.sum("saved").over(down).alias("saved_below"),
                             F.max("leaf").over(down).alias("leaf_below"), F.col("first").alias("first_below"))
        rows = rows.filter("goes_on").join(stash(found, "trie-below"), ["conv_id", "panel"]) \
            .unionByName(rows.filter("NOT goes_on").select("*", *none))
    nodes = stash(rows.groupBy("block").applyInArrow(_nodes, NODES), "trie-nodes")
    opened = nodes.filter("open")
    merged = opened.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.max("parent").alias("parent"),
                                      *[F.sum(c).alias(c) for c in sums], F.max("pkx").alias("pkx"), F.max("pky").alias("pky"))
    merged = stash(merged.join(_open_ends(opened), KEY), "trie-open")
    columns = ["conv_id", "depth", "parent", *sums, "ends", "pkx", "pky"]
    every = nodes.filter("NOT open").select(*columns).unionByName(merged.select(*columns))
    lookup = small(merged.select(F.col("kx").alias("pkx"), F.col("ky").alias("pky"), (F.col("depth") + 1).alias("depth"),
                                 F.col("conv_id").alias("found")))
    known = every.filter("pkx IS NULL").withColumn("found", F.col("parent"))
    asked = every.filter("pkx IS NOT NULL").join(lookup, ["pkx", "pky", "depth"])
    return known.unionByName(asked).select("conv_id", "depth", F.col("found").alias("parent_conv_id"), *sums,
                                           F.col("ends").alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of all rebuilt conversations.

    Defined cases: null roles and texts are empty; null turns come first, and
    turns of one number are ordered by a digest of role and text; repeated rows
    are turns of their own; a conversation without turns is a member of the
    root alone; rows without a conv_id belong to no conversation; an empty
    table has no nodes, not even a root.
    """
    return trie(*rebuilt(conversations))


ORACLE = r"""
WITH tab AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i, range(1, 9)),
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
k AS (
  SELECT conv_id, length(role) || ':' || role || text AS said, length(text) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(role) || ':' || role || text)) AS k FROM r),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
           string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INTEGER) + 1]))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM r), tab),
s AS (
  SELECT c.conv_id, 0 AS own, k.k, k.said, k.chars FROM c JOIN k ON k.conv_id = c.base AND k.k <= c.h
  UNION ALL
  SELECT c.conv_id, 1 AS own, k.k, k.said, k.chars FROM c JOIN k ON k.conv_id = c.conv_id AND k.k > c.h),
q AS (
  SELECT c.conv_id, coalesce(list(s.said ORDER BY own, k) FILTER (s.said IS NOT NULL), []) AS said,
         coalesce(list(s.chars ORDER BY own, k) FILTER (s.said IS NOT NULL), []) AS chars
  FROM c LEFT JOIN s USING (conv_id) GROUP BY c.conv_id),
m AS (
  SELECT conv_id, len(said) AS turns, d, said[1:d] AS path, CASE WHEN d = 0 THEN 0 ELSE chars[d] END AS chars
  FROM q, unnest(range(0, len(said) + 1)) AS u(d)),
n AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (turns = d), '')) AS ends
  FROM m GROUP BY path, d),
p AS (
  SELECT n.*, up.conv_id AS parent_conv_id, coalesce(down.n_children, 0) AS n_children
  FROM n LEFT JOIN n AS up ON up.d = n.d - 1 AND up.path = n.path[1:n.d - 1]
  LEFT JOIN (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL) AS down
    ON down.d = n.d AND down.path = n.path),
a AS (
  SELECT e AS d, path[1:e] AS path, sum(CAST(n_children = 0 AS INTEGER)) AS n_leaves, sum(saved) AS saved_tokens
  FROM p, unnest(range(0, d + 1)) AS u(e) GROUP BY ALL)
SELECT conv_id, p.d AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM p JOIN a ON a.d = p.d AND a.path = p.path"""

"""Document fingerprints as invertible Bloom lookup sketches.

A text's paragraphs (lines and their sentences, and the pieces of at most
``LONGEST`` characters that a longer one is cut into at places that its content
gives, in any script) are hashed to 64-bit digests, a repeated one with its occurrence number, and every digest is
added to one cell of each of three tables.  Subtracting the cells of two
versions cancels what they share; peeling cells that hold a single digest
recovers those that differ.  If peeling gets stuck, both versions are sketched
again with more cells, until it succeeds.  All tables of a batch are peeled
together in numpy.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLES = 3
CELLS = 18
GROWTH = 3
LARGEST = 16
#: Cells peeled at once, and characters of text measured at once.
BATCH_CELLS = 200_000
BATCH_CHARS = 2_000_000
#: Rows of one range of ids, where the session's shuffle partitions are fewer.
PART_ROWS = 50_000
#: Characters of a piece: a place where the last ``WINDOW`` of them hash to 0
#: modulo ``EVERY`` ends one that is long enough, and the longest ends anywhere.
SHORTEST, LONGEST = 32, 64
WINDOW, EVERY = 8, 16
_CUT = re.compile(r"\n|(?<=[.!?])\s+")
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray, k: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _K[k]
    x = (x ^ (x >> np.uint64(29))) * _K[(k + 1) % 4]
    return x ^ (x >> np.uint64(32))


def _ends(text: str) -> list[int]:
    """The offsets behind which the content of a text lets a piece end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(codes) < WINDOW:
        return []
    h = np.zeros(len(codes) - WINDOW + 1, np.uint64)
    for i in range(WINDOW):
        h = h * _K[0] + codes[i:i + len(h)]
    return (np.flatnonzero(_mix(h, 1) % np.uint64(EVERY) == 0) + WINDOW).tolist()


def pieces(text: str) -> Iterator[str]:
    """The paragraphs of a whole text, long ones in pieces.  Where a piece ends
    depends on the text before it alone, so a change leaves those before it."""
    ends, spans, start = _ends(text), [], 0
    for m in _CUT.finditer(text):
        spans.append((start, m.start()))
        start = m.end()
    for start, stop in [*spans, (start, len(text))]:
        while stop - start > SHORTEST:
            at = bisect_left(ends, start + SHORTEST)
            end = min(start + LONGEST, ends[at] if at < len(ends) else stop)
            if end >= stop:
                break
            yield text[start:end]
            start = end
        if start < stop:
            yield text[start:stop]


def digests(text: str) -> np.ndarray:
    """The digests of all paragraphs of a whole text."""
    seen: dict[str, int] = {}
    out = []
    for p in pieces(text):
        n = seen[p] = seen.get(p, -1) + 1
        raw = p.encode("utf-8", "surrogatepass")
        out.append(xxhash.xxh3_64_intdigest(b"%b\0%d" % (raw, n) if n else raw))
    return np.array(out, np.uint64)


def places(keys: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each key in each table: shape (TABLES, keys)."""
    width = cells // TABLES
    return np.stack([_mix(keys + np.uint64(cells), t) % np.uint64(width) + np.uint64(t * width)
                     for t in range(TABLES)]).astype(np.int64)


class Sketches:
    """Cells of many texts at once: counts, sums of digests, sums of checks."""

    def __init__(self, count: np.ndarray, keys: np.ndarray, checks: np.ndarray):
        self.count, self.keys, self.checks = count, keys, checks

    @classmethod
    def of(cls, sets: Sequence[np.ndarray], cells: int) -> Sketches:
        shape = len(sets) * cells
        self = cls(np.zeros(shape, np.int64), np.zeros(shape, np.uint64), np.zeros(shape, np.uint64))
        if sets:
            keys = np.concatenate(sets)
            self.add(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), keys, np.ones(len(keys), np.int64), cells)
        return self

    def add(self, row: np.ndarray, keys: np.ndarray, sign: np.ndarray, cells: int) -> None:
        check = _mix(keys, 3) * sign.astype(np.uint64)
        signed = keys * sign.astype(np.uint64)
        for at in places(keys, cells):
            flat = row * cells + at
            np.add.at(self.count, flat, sign)
            np.add.at(self.keys, flat, signed)
            np.add.at(self.checks, flat, check)

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(self.count - other.count, self.keys - other.keys, self.checks - other.checks)

    def peel(self, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Recover the differing digests: (row, digest, sign) of each, and which
        rows were emptied."""
        rows, found, signs = [], [], []
        while True:
            at = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[at].astype(np.uint64)
            key = self.keys[at] * sign
            at, key = at[ok := self.checks[at] * sign == _mix(key, 3)], key[ok]
            if not len(at):
                break
            row = at // cells
            order = np.lexsort((key, row))  # a digest may stand alone in several tables: take it once
            at, key, row = at[order], key[order], row[order]
            one = np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])]
            row, key, s = row[one], key[one], self.count[at[one]].copy()
            self.add(row, key, -s, cells)
            rows.append(row)
            found.append(key)
            signs.append(s)
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        empty = ~left.reshape(-1, cells).any(1)
        if not rows:
            none = np.empty(0, np.int64)
            return none, np.empty(0, np.uint64), none, empty
        return np.concatenate(rows), np.concatenate(found), np.concatenate(signs), empty

    def texts(self, sizes: list[int], cells: int) -> list[str]:
        """One string per text: its paragraph count and its cells."""
        table = np.zeros(len(sizes) * cells, dtype=[("c", "<u2"), ("k", "<u8"), ("h", "<u4")])
        table["c"], table["k"], table["h"] = self.count & 0xFFFF, self.keys, self.checks & np.uint64(0xFFFFFFFF)
        return [base64.b85encode(n.to_bytes(4, "little") + t.tobytes()).decode()
                for n, t in zip(sizes, table.reshape(len(sizes), cells))] if sizes else []


def differences(a: Sequence[np.ndarray], b: Sequence[np.ndarray], cells: int = CELLS) -> tuple[np.ndarray, list[int]]:
    """How many digests differ between a[i] and b[i], by subtracting and
    peeling; the ones that get stuck are sketched again with at least
    ``GROWTH`` times the cells, or twice what the stuck cells let expect.
    With ``LARGEST`` cells for each digest only equal digests of one text could
    still be in the way; such a pair is compared digest by digest.  Also
    returns how many went through each round."""
    out = np.zeros(len(a), np.int64)
    pending = {cells: np.arange(len(a))}
    rounds = []
    while pending:
        m = min(pending)
        todo = pending.pop(m)
        rounds.append(len(todo))
        step = max(1, BATCH_CELLS // m)
        for part in (todo[i:i + step] for i in range(0, len(todo), step)):
            x, y = [a[i] for i in part], [b[i] for i in part]
            diff = Sketches.of(x, m).minus(Sketches.of(y, m))
            width = m // TABLES
            net = np.array([len(p) - len(q) for p, q in zip(x, y)])
            squares = (diff.count.reshape(-1, m) ** 2).sum(1) / TABLES
            likely = (squares - net ** 2 / width) / (1 - 1 / width)
            row, _, _, empty = diff.peel(m)
            out[part] = np.bincount(row, minlength=len(part))
            for i, size in zip(part[~empty], likely[~empty]):
                if m > LARGEST * (len(a[i]) + len(b[i])) + CELLS * GROWTH:
                    out[i] = len(np.setxor1d(a[i], b[i]))
                    continue
                want = max(m * GROWTH, int(2 * size))
                want = CELLS * GROWTH ** int(np.ceil(np.log(want / CELLS) / np.log(GROWTH) - 1e-9))
                pending[want] = np.append(pending.get(want, np.empty(0, np.int64)), i)
    return out, rounds


def likeness(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> np.ndarray:
    """Shared digests over all digests of both, from the recovered difference;
    two empty texts are alike (1)."""
    d, _ = differences(a, b)
    both = np.array([len(x) + len(y) for x, y in zip(a, b)], np.int64)
    return np.where(both > 0, (both - d) / np.maximum(1, both + d), 1.0)


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by as much of ``after``."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def _longs(values: list[int]) -> Column:
    """An array constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values \
        else F.array().cast("array<bigint>")


def with_successors(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(part, doc_id, text, tail) sorted within partitions so that each row's
    successor in descending doc_id order (after the last: the first) is the
    next row of its part.

    The ids are cut into ranges at their quantiles; the first row of each range
    is also sent to the range before it, marked ``tail``.  Only the quantiles
    and one id per range reach the driver, and every text is shuffled once.
    Null ids come last, equal ids in the order of their texts.
    """
    spark = docs.sparkSession
    n = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // PART_ROWS))
    lowest = -(1 << 63)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest))
    ids = docs.select(key.alias("k"))
    found = ids.select(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0] or []
    cuts = sorted(set(found))
    # two short scans instead of one over all cuts: whole strides below the id, then one stride
    stride = max(1, int(len(cuts) ** 0.5))
    strides = F.size(F.filter(_longs(cuts[stride - 1::stride]), lambda b: b < F.col("k")))
    part = strides * stride + F.size(F.filter(F.slice(_longs(cuts), strides * stride + 1, stride),
                                              lambda b: b < F.col("k")))
    heads = {r["part"]: r["head"] for r in
             ids.withColumn("part", part).groupBy("part").agg(F.max("k").alias("head")).collect()}
    order = sorted(heads)  # the last part has the highest ids and comes first
    before = {p: order[(i + 1) % len(order)] for i, p in enumerate(order)}
    numbers = range(len(cuts) + 1)
    head_of = F.element_at(_longs([heads.get(p, lowest) for p in numbers]), F.col("part") + 1)
    part_before = F.element_at(_longs([before.get(p, 0) for p in numbers]), F.col("part") + 1).cast("int")
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("tail"))
    copy = F.struct(part_before.alias("part"), F.lit(True).alias("tail"))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), key.alias("k")) \
        .withColumn("part", part) \
        .withColumn("to", F.explode(F.when(F.col("k") == head_of, F.array(own, copy)).otherwise(F.array(own)))) \
        .select("to.part", "to.tail", "k", "doc_id", "text")
    return rows.repartition(n, "part").sortWithinPartitions("part", "tail", F.desc("k"), "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    Defined cases: a null text is the empty one, whose fingerprint has empty
    cells; a single document is its own successor; rows of one id follow each
    other in the order of their texts.
    """
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    names = [f.split()[0] for f in schema.split(", ")]

    def measured(rows: list[tuple]) -> pa.RecordBatch:
        ids, sizes, sums, own, new, after = zip(*rows)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums),
            pa.array(Sketches.of(own, CELLS).texts([len(x) for x in own], CELLS)),
            pa.array(Sketches.of(new, CELLS).texts([len(x) for x in new], CELLS)),
            pa.array(likeness(own, new)), pa.array(likeness(own, after))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (part, doc_id, text, digests) that waits for its successor
        rows, chars = [], 0
        for batch in batches:
            for part, tail, doc_id, text in zip(*(batch.column(c) for c in ("part", "tail", "doc_id", "text"))):
                part, tail = part.as_py(), tail.as_py()
                if tail and (last is None or last[0] != part):
                    continue  # a further row with the id of the range's head
                text = text.as_py()
                here = (part, doc_id.as_py(), text, digests(text))
                if last is not None and last[0] == part:
                    changed = edited(last[2], text)
                    rows.append((last[1], len(last[2]), hashlib.sha256(changed.encode("utf-8", "surrogatepass"))
                                 .hexdigest(), last[3], digests(changed), here[3]))
                    chars += len(changed)
                last = None if tail else here
                if chars >= BATCH_CHARS:
                    yield measured(rows)
                    rows, chars = [], 0
            if rows:
                yield measured(rows)
                rows, chars = [], 0

    return with_successors(docs).select("part", "tail", F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)

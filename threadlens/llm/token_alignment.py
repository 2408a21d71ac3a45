"""Cross-tokenizer alignment with counts of linked id pairs.

1.  Every task aligns its texts (``token_links``) and writes its distinct pairs
    with their counts, one row per hash bucket.
2.  Each bucket's distinct pairs get a minimal perfect hash (``perfect_hash``).
3.  Each row becomes a dense vector of counts indexed by that hash; vectors of
    one bucket are summed as a tree of ``FAN`` branches a step.
4.  A second pass aligns the texts again and looks every pair up: the hash
    gives its place, the key kept there is compared, and the count is read.

No link leaves its task.  A bucket holds at most |A| * |B| / 256 pairs, whatever
the corpus.  The counted pairs are broadcast in blocks of whole buckets of at
most ``PAIRS_AT_ONCE`` pairs (or one bucket); more pairs take more passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.byte_bpe import default_path, default_pattern
from threadlens.llm.common import sliced_batches, stash
from threadlens.llm.perfect_hash import BUCKETS, PerfectHash, bucket_of, build
from threadlens.llm.token_links import AT_ONCE, Links
from threadlens.llm.units import SLICE

FAN = 16
PAIRS_AT_ONCE = 4_000_000

#: A batch of results is sent on when its groups reach so many characters.
BATCH_CHARS = 8 << 20

SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
NOTHING = (0,) * len(SUMS)


def totals(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs (of any length, 0 too) along the last axis."""
    run = np.concatenate([np.zeros((*values.shape[:-1], 1), values.dtype), np.cumsum(values, -1)], -1)
    ends = np.cumsum(lengths)
    return run[..., ends] - run[..., ends - lengths]


def _small_texts(texts: list[str | None], links: Links) -> Iterator[list[tuple[int, list[str]]]]:
    """Row numbers with their units, of about ``AT_ONCE`` units at a time."""
    group, held = [], 0
    for i, text in enumerate(texts):
        if text and len(text) <= SLICE:
            group.append((i, next(links.split(text))))
            held += len(group[-1][1])
            if held >= AT_ONCE:
                yield group
                group, held = [], 0
    if group:
        yield group


class PairCounts:
    """Occurrences of units, turned into counts of pairs when the store is full."""

    def __init__(self, links: Links):
        self.links, self.times = links, np.zeros(0, np.int64)

    def room(self, units: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        new = self.links.unknown(units)
        if self.links.full(new):
            yield from self.flush()
            new = self.links.unknown(units)
        self.links.learn(new)
        self.times = np.concatenate([self.times, np.zeros(len(self.links.index) - len(self.times), np.int64)])

    def flush(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        keys, at = np.unique(self.links.keys, return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, at, np.repeat(self.times, self.links.sizes[3]))
        yield keys[counts > 0], counts[counts > 0]
        self.links.forget()
        self.times = np.zeros(0, np.int64)

    def add(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        links = self.links
        for group in _small_texts(texts, links):
            units = [u for _, own in group for u in own]
            yield from self.room(units)
            numbers, lengths = links.numbers(units), np.array([len(own) for _, own in group])
            whole = totals((~links.valid[numbers]).astype(np.int64), lengths) == 0
            self.times += np.bincount(numbers[np.repeat(whole, lengths)], minlength=len(self.times))
        for text in texts:
            if text and len(text) > SLICE:
                good = True
                for units in links.split(text):  # a text counts only if all of it is valid
                    yield from self.room(units)
                    good = good and bool(links.valid[links.numbers(units)].all())
                for units in links.split(text) if good else ():
                    yield from self.room(units)
                    self.times += np.bincount(links.numbers(units), minlength=len(self.times))


def _pair_rows(docs: DataFrame, shared) -> DataFrame:
    """(task, bucket, keys, counts) of each task's distinct pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()

        def rows(keys, counts):
            bucket = bucket_of(keys)
            order = np.argsort(bucket, kind="stable")
            found, starts = np.unique(bucket[order], return_index=True)
            ends = [*starts[1:].tolist(), len(order)]
            parts = [order[i:j] for i, j in zip(starts.tolist(), ends)]
            return pa.RecordBatch.from_arrays([
                pa.array([task] * len(found), pa.int32()), pa.array(found, pa.int32()),
                pa.array([keys[p].tobytes() for p in parts], pa.binary()),
                pa.array([counts[p].tobytes() for p in parts], pa.binary())], names=["task", "bucket", "keys", "counts"])

        count = PairCounts(Links(*shared.value, groups=False))
        for batch in sliced_batches(batches):
            for found in count.add(batch.column(0).to_pylist()):
                yield rows(*found)
        for found in count.flush():
            yield rows(*found)
    return docs.select(F.col("text").cast("string")).mapInArrow(run, "task int, bucket int, keys binary, counts binary")


def _folded(rows: DataFrame, by: list[str], names: list[str], schema: str, start: Callable, step: Callable,
            end: Callable) -> DataFrame:
    """One row per group: a fold over the group's rows, which stream past in
    order of ``by``, so a group is never held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, None
        out = pa.schema(_ARROW[f.split()[1]](f.split()[0]) for f in schema.split(", "))

        def closed():
            return pa.RecordBatch.from_pylist([dict(zip(out.names, (*here, *end(state))))], schema=out)
        for batch in batches:
            for row in zip(*(batch.column(c) for c in (*by, *names))):
                row = [v.as_py() for v in row]
                if here != row[:len(by)]:
                    if here is not None:
                        yield closed()
                    here, state = row[:len(by)], start()
                state = step(state, *row[len(by):])
        if here is not None:
            yield closed()
    tasks = min(BUCKETS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, *by).sortWithinPartitions(*by).select(*by, *names).mapInArrow(run, schema)


_ARROW = {"int": lambda name: pa.field(name, pa.int32()), "long": lambda name: pa.field(name, pa.int64()),
          "binary": lambda name: pa.field(name, pa.binary())}


def _functions(pairs: DataFrame) -> DataFrame:
    """(bucket, n, sizes, words, keys): each bucket's perfect hash and its
    distinct keys in the order of their numbers."""
    def end(keys):
        sizes, words = build(keys)
        number = PerfectHash.of({int(bucket_of(keys[:1])[0]): (sizes, words)}).number(keys)
        placed = np.empty_like(keys)
        placed[number] = keys
        return len(keys), sizes.tobytes(), words.tobytes(), placed.tobytes()
    return _folded(pairs, ["bucket"], ["keys"], "bucket int, n long, sizes binary, words binary, keys binary",
                   lambda: np.empty(0, np.uint64), lambda own, keys: np.union1d(own, np.frombuffer(keys, np.uint64)), end)


def _vector_sums(pairs: DataFrame, functions: DataFrame) -> DataFrame:
    """(bucket, counts): the dense vectors of all tasks, summed as a tree."""
    schema = "bucket int, branch int, counts binary"

    def scatter(vector, n, bucket, sizes, words, keys, counts):
        vector = np.zeros(n, np.int64) if vector is None else vector
        function = PerfectHash.of({bucket: (np.frombuffer(sizes, np.int64), np.frombuffer(words, np.uint64))})
        vector[function.number(np.frombuffer(keys, np.uint64))] += np.frombuffer(counts, np.int64)
        return vector

    def add(vector, counts):
        counts = np.frombuffer(counts, np.int64)
        return counts.copy() if vector is None else np.add(vector, counts, out=vector)
    branches = (pairs.agg(F.max("task")).first()[0] or 0) // FAN + 1
    rows = pairs.join(functions.select("bucket", "n", "sizes", "words"), "bucket") \
        .select("*", F.floor(F.col("task") / FAN).cast("int").alias("branch"), F.col("bucket").alias("own"))
    sums = _folded(rows, ["bucket", "branch"], ["n", "own", "sizes", "words", "keys", "counts"], schema,
                   lambda: None, scatter, lambda vector: (vector.tobytes(),))
    while branches > 1:
        branches = (branches - 1) // FAN + 1
        rows = sums.withColumn("branch", F.floor(F.col("branch") / FAN).cast("int"))
        sums = _folded(rows, ["bucket", "branch"], ["counts"], schema, lambda: None, add,
                       lambda vector: (vector.tobytes(),))
    return sums.select("bucket", "counts")


def pair_counts(docs: DataFrame, shared) -> DataFrame:
    """(bucket, n, sizes, words, keys, counts), a row per bucket that has pairs:
    its perfect hash, and the pairs and their counts in the hash's order."""
    pairs = stash(_pair_rows(docs, shared), "token-pairs")
    functions = stash(_functions(pairs), "pair-hashes")
    return stash(functions.join(_vector_sums(pairs, functions), "bucket"), "pair-counts")


def _best(counted: DataFrame, width: int) -> np.ndarray:
    """Per id of B: its highest count (a vector of the vocabulary's size)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(width, np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                own = np.frombuffer(keys.as_py(), np.uint64) % np.uint64(width)
                np.maximum.at(best, own.astype(np.int64), np.frombuffer(counts.as_py(), np.int64))
        there = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(best[there], pa.int64())],
                                         names=["b", "most"])
    best = np.zeros(width, np.int64)
    for r in counted.select("keys", "counts").mapInArrow(run, "b long, most long") \
            .groupBy("b").agg(F.max("most").alias("most")).collect():
        best[r["b"]] = r["most"]
    return best


class Lookup:
    """Counts of the pairs of some buckets; 0 for any other pair."""

    def __init__(self, rows: list[tuple]):
        self.function = PerfectHash.of({b: (np.frombuffer(s, np.int64), np.frombuffer(w, np.uint64))
                                        for b, s, w, _, _ in rows})
        rows = sorted(rows)
        self.keys = np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(r[3], np.uint64) for r in rows]])
        self.counts = np.concatenate([np.empty(0, np.int64), *[np.frombuffer(r[4], np.int64) for r in rows]])

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        number = self.function.number(keys)
        out = np.zeros(len(keys), np.int64)
        known = number >= 0
        known[known] = self.keys[number[known]] == keys[known]  # only a key that is kept there has that count
        out[known] = self.counts[number[known]]
        return out


class Measures:
    """Sums and groups of texts from the sums and groups of their units."""

    def __init__(self, links: Links, lookup: Lookup, best: np.ndarray):
        self.links, self.lookup, self.best = links, lookup, best
        self.own = np.zeros((len(SUMS), 0), np.int64)

    def room(self, units: list[str]) -> None:
        links = self.links
        new = links.unknown(units)
        if links.full(new):
            links.forget()
            self.own = self.own[:, :0]
            new = links.unknown(units)
        start, keys = len(links.index), links.learn(new)
        sizes, counts = links.sizes[:, start:], self.lookup(keys)
        best = (counts > 0) & (counts == self.best[(keys % np.uint64(links.width)).astype(np.int64)])
        found = totals(np.stack([best.astype(np.int64), counts]), sizes[3])
        self.own = np.concatenate([self.own, np.concatenate([sizes, found])], 1)

    def of(self, texts: list[str | None]) -> Iterator[tuple[int, tuple, str]]:
        """(row, sums, groups) of every text that has tokens."""
        links = self.links
        for group in _small_texts(texts, links):
            units = [u for _, own in group for u in own]
            self.room(units)
            numbers, lengths = links.numbers(units), np.array([len(own) for _, own in group])
            whole = totals((~links.valid[numbers]).astype(np.int64), lengths) == 0
            sums, ends = totals(self.own[:, numbers], lengths).T.tolist(), np.cumsum(lengths)
            shapes = list(map(links.shape.__getitem__, numbers.tolist()))
            for (i, _), good, own, size, end in zip(group, whole, sums, lengths, ends):
                if good:
                    yield i, tuple(own), "".join(shapes[end - size:end])[:-1]
        for i, text in enumerate(texts):
            if text and len(text) > SLICE:
                sums, shapes, good = np.zeros(len(SUMS), np.int64), [], True
                for units in links.split(text):
                    self.room(units)
                    numbers = links.numbers(units)
                    good = good and bool(links.valid[numbers].all())
                    if not good:
                        break
                    sums += self.own[:, numbers].sum(1)
                    shapes.append("".join(map(links.shape.__getitem__, numbers.tolist())))
                if good:
                    yield i, tuple(sums.tolist()), "".join(shapes)[:-1]


def _measured(rows: DataFrame, shared, block, best, last: bool) -> DataFrame:
    """The documents with their sums and groups.  ``rows`` are (doc_id, text)
    and, from earlier blocks, n_best and count_sum, to which this block's are
    added.  Unless this block is the last, rows of that kind come out again:
    the text goes along, as ids may repeat and can't be joined by."""
    later = "n_best" in rows.columns
    names = ["doc_id", *SUMS, "groups"] if last else ["doc_id", "text", "n_best", "count_sum"]
    kinds = {"text": "string", "groups": "string"}
    arrow = pa.schema([pa.field(c, pa.string() if c in kinds else pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measures = Measures(Links(*shared.value, groups=last), Lookup(block.value), best.value)
        for batch in sliced_batches(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            before = list(zip(*(batch.column(c).to_pylist() for c in (2, 3)))) if later else None
            out, held, seen = [], 0, set()

            def row(i, sums, groups):
                found = (ids[i], *sums, groups) if last else (ids[i], texts[i], *sums[4:])
                at = names.index("n_best")
                return (*found[:at], found[at] + before[i][0], found[at + 1] + before[i][1], *found[at + 2:]) \
                    if later else found
            found = measures.of(texts)
            for i, sums, groups in found:
                seen.add(i)
                out.append(row(i, sums, groups))
                held += len(groups) if last else len(texts[i])
                if held >= BATCH_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                    out, held = [], 0
            out += [row(i, NOTHING, "") for i in range(len(ids)) if i not in seen]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
    return rows.mapInArrow(run, ", ".join(f"{c} {kinds.get(c, 'long')}" for c in names))


def aligned(docs: DataFrame, json_path: str | None = None, model_path: str | None = None, pattern: str | None = None,
            pairs_at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links (overlapping
    token occurrences), n_best (links whose pair's count is the highest of its
    B id, ties included), count_sum (of the links' counts) and ``groups``:
    ``a1,a2|b1;a3|b2,b3``.

    A is a byte-level BPE (``json_path``) on a blank and the text, B a
    sentencepiece model (``model_path``) that adds the blank itself.

    Defined cases: a null or empty text, and one whose joined bytes on either
    side are not a blank and the text (a text with U+2581), has no tokens:
    zeros and empty groups, and it counts nothing; rows repeat as they come,
    and repeated texts count each time; an empty table gives no rows.
    """
    spark = docs.sparkSession
    with open(json_path or default_path("byte_bpe_50k.json"), encoding="utf-8") as a, \
            open(model_path or default_path("piece_bpe_32k.model"), "rb") as b:
        files = (a.read(), pattern or default_pattern(), b.read())
    shared = spark.sparkContext.broadcast(files)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = pair_counts(rows, shared)
    best = spark.sparkContext.broadcast(_best(counted, Links(*files, groups=False).width))
    blocks, held = [[]], 0
    for r in counted.select("bucket", "n").orderBy("bucket").collect():  # a number per bucket
        if blocks[-1] and held + r["n"] > pairs_at_once:
            blocks.append([])
            held = 0
        blocks[-1].append(r["bucket"])
        held += r["n"]
    for n, block in enumerate(blocks):
        table = [(r[0], *map(bytes, r[1:])) for r in counted.filter(F.col("bucket").isin(block))
                 .select("bucket", "sizes", "words", "keys", "counts").collect()]
        last = n + 1 == len(blocks)
        rows = _measured(rows, shared, spark.sparkContext.broadcast(table), best, last)
        if not last:
            rows = stash(rows, "alignment-block")
    return rows


def digests(docs: DataFrame) -> DataFrame:
    """``aligned`` with the SHA-256 of the groups (none: the empty string)."""
    out = aligned(docs)
    return out.select("doc_id", *SUMS, F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
                      .alias("groups_sha256"))

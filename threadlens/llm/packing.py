"""Conflict-constrained best-fit packing.

Documents are packed into sequences ("bins") of ``capacity`` words.  A bin holds
at most one document of each source and one of each duplicate cluster: it
carries a bitmap of both.  Pieces go largest first into the tightest bin that
holds them without conflict: bins are ordered by the room they have left, and
the search goes on from the smallest sufficient room upwards until a compatible
bin is found, or opens a new one.

A text longer than a bin is cut into full bins and a rest.  Documents are dealt
by hash into blocks of bounded size, and each block is packed by itself, so the
work is spread evenly whatever the sources' sizes.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import id_key, stash
from threadlens.llm.mixing import word_count

CAPACITY = 1024
BLOCK_ROWS = 4096
SEED = 11


class Bins:
    """Open bins ordered by residual room.  Bins with the same room and the
    same source bitmap form one group, so a conflict of sources passes over
    all of them at once."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []
        self.groups: dict[int, dict[int, list[int]]] = {}
        self.clusters: list[int] = []

    def _put(self, room: int, sources: int, bin_id: int) -> None:
        if not room:
            return
        if room not in self.groups:
            insort(self.rooms, room)
            self.groups[room] = {}
        insort(self.groups[room].setdefault(sources, []), bin_id)

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Put a piece into the tightest compatible bin: (bin, offset).
        ``source`` and ``cluster`` are bitmaps; equal room goes to the lowest
        bin number."""
        for i in range(bisect_left(self.rooms, size), len(self.rooms)):
            room = self.rooms[i]
            best = None
            for sources, bins in self.groups[room].items():
                if not sources & source:
                    fit = next((b for b in bins if not self.clusters[b] & cluster), None)
                    if fit is not None and (best is None or fit < best[0]):
                        best = fit, sources
            if best:
                bin_id, sources = best
                group = self.groups[room][sources]
                group.remove(bin_id)
                if not group:
                    del self.groups[room][sources]
                    if not self.groups[room]:
                        del self.groups[room]
                        self.rooms.pop(i)
                self.clusters[bin_id] |= cluster
                self._put(room - size, sources | source, bin_id)
                return bin_id, self.capacity - room
        self.clusters.append(cluster)
        self._put(self.capacity - size, source, len(self.clusters) - 1)
        return len(self.clusters) - 1, 0


def pack_block(rows: list[tuple], capacity: int) -> list[tuple]:
    """Pack (doc_id, key, size, source, cluster) rows, size >= 1: a list of
    (doc_id, size, source, piece, start, length, bin, offset)."""
    bit = {s: 1 << i for i, s in enumerate(sorted({r[3] for r in rows}, key=lambda s: (s is None, s or "")))}
    shared = sorted(c for c, n in Counter(r[4] for r in rows).items() if n > 1)
    mark = {c: 1 << i for i, c in enumerate(shared)}  # a cluster of one cannot conflict
    bins, out, rests = Bins(capacity), [], []
    for doc_id, key, size, source, cluster in sorted(rows, key=lambda r: (r[1], r[4], r[2], r[3] or "")):
        whole, rest = divmod(size, capacity)
        for piece in range(whole):
            at = bins.place(capacity, bit[source], mark.get(cluster, 0))
            out.append((doc_id, size, source, piece, piece * capacity, capacity, *at))
        if rest:
            rests.append((rest, doc_id, size, source, cluster, whole))
    for rest, doc_id, size, source, cluster, whole in sorted(rests, key=lambda r: -r[0]):
        at = bins.place(rest, bit[source], mark.get(cluster, 0))
        out.append((doc_id, size, source, whole, whole * capacity, rest, *at))
    return out


def packed(docs: DataFrame, capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per piece: doc_id, size (words plus one end mark), source, piece,
    start, length, block, bin, offset.  A bin is (block, bin); its pieces lie
    one behind the other from offset 0.

    Duplicate clusters are equal texts.  Defined cases: a null or empty text is
    its end mark alone (size 1); null sources are one source; repeated rows are
    separate documents of one cluster; a null id is packed under its text.
    Extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), id_key().alias("key"),
                       (word_count() + 1).cast("long").alias("size"), F.col("source").cast("string"),
                       F.xxhash64("text").alias("cluster"))
    rows = stash(rows, "pack-rows")
    blocks = max(1, -(-rows.count() // block_rows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "key", "cluster"), F.lit(blocks)).cast("int"))
    names = ["doc_id", "size", "source", "piece", "start", "length", "bin", "offset"]

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(None if d is None or d != d else int(d), k, int(n), s, c) for d, k, n, s, c in
                zip(pdf["doc_id"].astype(object), pdf["key"], pdf["size"], pdf["source"], pdf["cluster"])]
        out = pd.DataFrame(pack_block(rows, capacity), columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        out["block"] = pdf["block"].iloc[0]
        return out

    return dealt.groupBy("block").applyInPandas(
        block, "doc_id long, size long, source string, piece long, start long, length long, bin long, offset long, "
               "block int")

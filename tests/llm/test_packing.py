import random
from collections import Counter, defaultdict

from corpus_helpers import SCHEMA, frame, odd_rows, prose, with_clashes

from threadlens.llm import packing


def brute_block(rows, capacity):
    """Best fit by looking at every bin for every piece."""
    bins, out, rests = [], [], []
    for doc_id, key, size, source, cluster in sorted(rows, key=lambda r: (r[1], r[4], r[2], r[3] or "")):
        whole, rest = divmod(size, capacity)
        for piece in range(whole):
            bins.append([0, {source}, {cluster}])
            out.append((doc_id, size, source, piece, piece * capacity, capacity, len(bins) - 1, 0))
        if rest:
            rests.append((rest, doc_id, size, source, cluster, whole))
    for rest, doc_id, size, source, cluster, whole in sorted(rests, key=lambda r: -r[0]):
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= rest and source not in b[1] and cluster not in b[2]]
        if fits:
            room, at = min(fits)
            bins[at] = [room - rest, bins[at][1] | {source}, bins[at][2] | {cluster}]
        else:
            room, at = capacity, len(bins)
            bins.append([capacity - rest, {source}, {cluster}])
        out.append((doc_id, size, source, whole, whole * capacity, rest, at, capacity - room))
    return out


def test_block_equals_brute_force():
    rng = random.Random(1)
    for capacity in (7, 50, 1024):
        rows = [(i, str(i), rng.randint(1, capacity * 3 if i % 9 == 0 else capacity), rng.choice(["a", "b", "c", None]),
                 rng.choice([1, 2, 100 + i])) for i in range(300)]
        assert packing.pack_block(rows, capacity) == brute_block(rows, capacity)


def check(out, capacity):
    pieces = defaultdict(list)
    for r in out:
        pieces[(r.block, r.bin)].append(r)
    for members in pieces.values():
        members.sort(key=lambda r: r.offset)
        at = 0
        for r in members:
            assert r.offset == at
            at += r.length
        assert at <= capacity
        assert len({r.source for r in members}) == len(members)


def test_whole_texts_in_valid_bins(spark):
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(1, 90)) for _ in range(150)]
    rows = [(i, rng.choice(texts), "hot" if i % 3 == 0 else f"s{i % 6}") for i in range(600)]
    out = packing.packed(frame(spark, rows), capacity=64, block_rows=100).collect()
    check(out, 64)
    words = Counter()
    for r in out:
        words[r.doc_id] += r.length
    assert words == Counter({i: len(t.split()) + 1 for i, t, _ in rows})
    text = {i: t for i, t, _ in rows}
    bins = defaultdict(list)
    for r in out:
        bins[(r.block, r.bin)].append(text[r.doc_id])
    assert all(len(set(b)) == len(b) for b in bins.values())


def test_odd_rows(spark):
    out = packing.packed(with_clashes(frame(spark, odd_rows())), capacity=1000).collect()
    check(out, 1000)
    assert sum(r.length for r in out if r.doc_id == 6) == 30_001
    assert sum(1 for r in out if r.doc_id == 5) == 2
    assert {r["size"] for r in out if r.doc_id in (1, 2, 3)} == {1}
    assert packing.packed(spark.createDataFrame([], SCHEMA)).collect() == []

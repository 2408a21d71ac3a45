import random
from collections import defaultdict

import pytest
from corpus_helpers import SCHEMA, frame, odd_rows, prose, with_clashes

from threadlens.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), budget=1.5, cap=2.0):
    """Water-filling by rounds of clamping and resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    words = budget * sum(sizes.values())
    fixed = {}
    while True:
        rest = words - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        share = {s: weight[s] * rest / total for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **share}
        for s in over:
            fixed[s] = cap * sizes[s]


def test_targets_and_taken_words(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(1, 60)), "hot" if i % 3 == 0 else f"s{i % 7}" if i % 11 else None)
            for i in range(900)]
    out = mixing.mixed_sizes(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    source = {i: s for i, _, s in rows}
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in out:
        sizes[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r["size"])
        assert r.taken == r["size"] * r.copies <= 2 * r["size"]
    targets = brute_targets(sizes)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(targets[s])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s]
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.mixed_sizes(frame(spark, rows)).collect()))


def test_rows_of_the_mixture_follow_the_sizes(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(1, 30)), f"s{i % 5}") for i in range(200)]
    docs = with_clashes(frame(spark, rows))
    copies = {r.doc_id: r.copies for r in mixing.mixed_sizes(docs).collect()}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id] += 1
    assert {i: n for i, n in copies.items() if n} == dict(got)


def test_odd_rows(spark):
    docs = with_clashes(frame(spark, odd_rows()))
    out = mixing.mixed_sizes(docs).collect()
    assert len(out) == len(odd_rows())
    assert {r["size"] for r in out if r.doc_id in (1, 2, 3)} == {0}
    mixing.mixed(docs).collect()
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed_sizes(empty).collect() == []
    assert mixing.mixed(empty).collect() == []

import random

from corpus_helpers import SCHEMA, components, frame, odd_rows, prose, shingles, with_clashes

from threadlens.llm import near_dup
from threadlens.plans.inspect import explain_string


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(rng, groups=12, size=14, words=120, passage=""):
    rows, n = [], 0
    for g in range(groups):
        base = prose(rng, words)
        for c in range(size):
            text = edited(rng, base, rng.randrange(0, 7)) + passage
            rows += [(n, text, "a")] * (1 if c else 2)
            n += 1
    rows += [(n + i, prose(rng, rng.randint(1, 90)) + passage, "b") for i in range(60)]
    rng.shuffle(rows)
    return [(i, t, s) for i, (_, t, s) in enumerate(rows)]


def check(spark, rows, **options):
    out = near_dup.near_duplicates(frame(spark, rows), **options).collect()
    want = components(rows)
    assert {r.doc_id: r.component_id for r in out} == want
    for r in out:
        assert r.kept == (r.doc_id == r.component_id)
    sizes = {i: len(shingles(t)) for i, t, _ in rows}
    assert {r.doc_id: r.n_shingles for r in out} == sizes
    assert len(set(want.values())) < len(want)


def test_components_equal_brute_force(spark):
    check(spark, corpus(random.Random(1)))


def test_long_lists_take_the_exact_way(spark):
    """Every list of more than four members goes by its centre and by the
    full-set lists; a passage that all documents share must not link them."""
    rng = random.Random(2)
    check(spark, corpus(rng, groups=6, size=25, passage=" " + prose(rng, 60)), list_limit=4)


def test_small_sketches_miss_nothing_here(spark):
    check(spark, corpus(random.Random(5), groups=8, size=10, words=300), list_limit=3)


def test_chain_of_links(spark):
    """Each text is near its neighbour only; the component spans the chain."""
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 10:i * 10 + 120]), "a") for i in range(20)]
    check(spark, rows)


def test_odd_rows(spark):
    out = near_dup.near_duplicates(with_clashes(frame(spark, odd_rows()))).collect()
    assert len(out) == len(odd_rows())
    by_id = {r.doc_id: r for r in out if r.doc_id is not None}
    for i in (1, 2, 3):
        assert (by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert by_id[9].component_id == 8 and not by_id[9].kept
    assert by_id[5].n_shingles == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert near_dup.near_duplicates(empty).collect() == []


def test_one_per_group_keeps_columns_and_one_of_each(spark):
    docs = with_clashes(frame(spark, odd_rows()))
    kept = near_dup.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert ids.count(None) == 2


def test_one_per_group_shuffles_no_text_but_repeated_rows(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 40), "s") for i in range(20)]
    rows += [(20, rows[3][1], "t"), (21, rows[4][1] + " end", "t")]
    kept = near_dup.one_per_group(frame(spark, rows))
    assert "hashpartitioning" not in explain_string(kept)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(20))
    repeated = [(5, rows[5][1], "u"), (20, rows[3][1], "u"), (30, None, "s"), (30, None, "u"), (None, " ", "s"), (None, " ", "u")]
    got = near_dup.one_per_group(frame(spark, rows + repeated)).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == [*range(20), 30]
    assert len(got) == 22


def test_the_estimate_keeps_pairs_with_27_of_64_common_values(spark):
    rows = [(1, list(range(64)))] + [(x, list(range(x)) + list(range(1000 * x, 1000 * x + 64 - x))) for x in (26, 27, 32, 33)]
    reps = spark.createDataFrame(rows, "rep long, sketch array<long>")
    pairs = spark.createDataFrame([(1, x) for x in (26, 27, 32, 33)], "a long, b long")
    assert sorted(r.b for r in near_dup.estimated(pairs, reps, 64, 75).collect()) == [27, 32, 33]


def test_repeated_and_null_ids_lose_no_link(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(5, a, "s"), (5, b, "s"), (9, b + " more", "s"), (None, a, "s"), (None, a + " end", "s"), (7, a + " end", "s"),
            (None, "c " * 30 + "alone", "s"), (None, "c " * 30 + "alone", "s"), (None, None, "s"), (None, " ", "s")]
    out = near_dup.near_duplicates(frame(spark, rows)).collect()
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in out)
    assert [g for g in got if g[0] == 9] == [(9, 57, 5, False)]
    assert [g for g in got if g[0] == 7] == [(7, 57, 5, False)]
    assert [g[2:] for g in got if g[0] == 5] == [(5, True), (5, True)]
    assert sorted(g[2:] for g in got if g[0] == -1 and g[1] > 50) == [(5, False), (5, False)]
    kept = near_dup.one_per_group(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id) == [5, 5]
    assert sorted(r.text or "" for r in kept if r.doc_id is None) == ["", " ", "c " * 30 + "alone"]


def test_against_all_pairs_with_repeated_and_null_ids(spark):
    import random
    rng = random.Random(12)
    base = [prose(rng, 40) for _ in range(12)]
    rows = []
    for _ in range(90):
        words = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 3)}"
        rows.append((rng.choice([None, *range(40)]), " ".join(words), "s"))
    by_row = components([(i, t, "s") for i, (_, t, _) in enumerate(rows)])
    smallest = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            smallest[by_row[i]] = min(doc_id, smallest.get(by_row[i], doc_id))
    want = sorted(str((doc_id, smallest.get(by_row[i]))) for i, (doc_id, _, _) in enumerate(rows))
    out = near_dup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.component_id)) for r in out) == want
    kept = near_dup.one_per_group(frame(spark, rows)).collect()
    assert len(kept) == len(set(by_row.values()))
    at = {(doc_id, t): by_row[i] for i, (doc_id, t, _) in enumerate(rows)}
    assert len({at[(r.doc_id, r.text)] for r in kept}) == len(kept)

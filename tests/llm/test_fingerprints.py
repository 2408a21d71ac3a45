import hashlib
import random

import numpy as np
from corpus_helpers import SCHEMA, frame, odd_rows, prose, with_clashes

from threadlens.llm import fingerprints as fp


def test_peeling_recovers_the_difference():
    rng = np.random.default_rng(1)
    for shared, only_a, only_b in ((0, 0, 0), (50, 3, 2), (500, 8, 0), (20, 200, 150), (0, 1, 0), (0, 900, 900)):
        keys = rng.integers(0, 2**63, shared + only_a + only_b).astype(np.uint64)
        a, b = keys[:shared + only_a], np.r_[keys[:shared], keys[shared + only_a:]]
        d, rounds = fp.differences([a], [b])
        assert d[0] == only_a + only_b
        cells = fp.CELLS * 3**6
        diff = fp.Sketches.of([a], cells).minus(fp.Sketches.of([b], cells))
        _, found, sign, empty = diff.peel(cells)
        assert empty.all()
        assert set(found[sign > 0].tolist()) == set(keys[shared:shared + only_a].tolist())
        assert set(found[sign < 0].tolist()) == set(keys[shared + only_a:].tolist())
    assert len(rounds) > 1  # the large difference needed a larger sketch


def test_short_and_repeated_paragraphs_have_their_own_digests():
    text = "\n".join(["|", "a", "b", "|", "ab"] * 3000)
    assert len(set(fp.digests(text).tolist())) == 15_000


def test_half_an_unchanged_text_keeps_digests_without_any_paragraph():
    rng = random.Random(8)
    after = "Another text. With a line\nand more. " * 900
    for text in ("word " * 400, "alpha, beta; " * 300, "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(3000)),
                 "漢字。" * 200, "\r".join(f"line {rng.random()}" for _ in range(90)), "x" * 128):
        assert "".join(fp.pieces(text)) == text and max(map(len, fp.pieces(text))) <= fp.LONGEST
        sets = [set(fp.digests(t).tolist()) for t in (text, fp.edited(text, after))]
        assert len(sets[0] & sets[1]) >= len(sets[0]) // 2 - 1 > -1 and sets[0] & sets[1]
        later = set(fp.digests("put before " + text).tolist())
        assert len(set(text)) < 40 or len(sets[0] & later) > 0.6 * len(sets[0])


def test_a_pair_that_cannot_be_peeled_ends():
    twice = np.array([7, 7, 9], np.uint64)
    d, rounds = fp.differences([twice], [np.array([1], np.uint64)])
    assert len(rounds) < 8 and d[0] == 3


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = {}
    for i, (doc_id, text, _) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + after[:half]
        sets = [set(fp.digests(t).tolist()) for t in (text, new, after)]
        like = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out.setdefault(doc_id, []).append((len(text), hashlib.sha256(new.encode()).hexdigest(), *like))
    return out


def check(spark, rows):
    out = fp.fingerprints(with_clashes(frame(spark, rows))).collect()
    assert len(out) == len(rows)
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append((r.n_chars, r.edited_sha256, r.near_edited, r.near_next))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in brute(rows).items()}
    by_text = {}
    for r in out:
        text = next((t for i, t, _ in rows if i == r.doc_id), "") or ""
        if r.doc_id is not None:
            assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    return out


def test_successors_and_likeness(spark):
    rng = random.Random(3)
    rows = [(i * 7 - 300, prose(rng, rng.randint(0, 200)), "a") for i in range(150)]
    rows += [(10_000 + i, rows[5][1], "b") for i in range(5)]
    rng.shuffle(rows)
    out = check(spark, rows)
    assert sum(r.near_edited > r.near_next for r in out) > 100


def test_odd_rows(spark):
    rows = [r for r in odd_rows() if r[0] is not None] + [(None, "last", "a")]
    check(spark, rows)
    check(spark, rows[:1])
    check(spark, rows[-1:])
    assert len(fp.fingerprints(frame(spark, odd_rows())).collect()) == len(odd_rows())
    assert fp.fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []

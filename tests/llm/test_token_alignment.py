import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_helpers import SCHEMA, frame, odd_rows, prose, with_clashes

from threadlens.llm import perfect_hash, token_alignment
from threadlens.llm.byte_bpe import default_path
from threadlens.llm.token_links import Links

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    a = tokenizers.Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=default_path("piece_bpe_32k.model"))
    chars = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in chars]
    of = {chr(x): x for x in chars} | {chr(256 + i): x for i, x in enumerate(rest)}

    def tokens(text):
        """[(id, bytes)] of both sides, encoding the whole text at once."""
        ids = a.encode(" " + text, add_special_tokens=False).ids
        first = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in ids]
        second = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        return first, second
    return tokens


def brute(texts, tokens):
    """Rows of the contract, link by link."""
    links, shapes, sides = [], [], []
    for text in texts:
        a, b = tokens(text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            a, b = [], []
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        found, j = [], 0
        for i, start, end in spans[0]:
            while j and spans[1][j - 1][2] > start:
                j -= 1
            while j < len(spans[1]) and spans[1][j][1] < end:
                if spans[1][j][2] > start:
                    found.append((i, spans[1][j][0]))
                j += 1
        links.append(found)
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        shapes.append(";".join("|".join(",".join(str(i) for i, s, e in own if lo <= s and e <= hi) for own in spans)
                               for lo, hi in zip([0, *common], common)))
        sides.append((len(a), len(b), len(common)))
    count = Counter(x for found in links for x in found)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(*n, len(found), sum(count[x] == best[x[1]] for x in found), sum(count[x] for x in found),
             hashlib.sha256(shape.encode()).hexdigest() if shape else "")
            for n, found, shape in zip(sides, links, shapes)]


def corpus():
    rng = random.Random(8)
    alphabet = list("abXY09 \n\t  '.é漢Ä　\xa0\U0001f600") + ["<|endoftext|>", "<s>", "<0x41>", "▁", "'ll", "​"]
    rows = odd_rows()[:8] + [(50 + i, "".join(rng.choices(alphabet, k=rng.randint(0, 30))), "r") for i in range(250)]
    rows += [(400 + i, prose(rng, 60), "s") for i in range(30)] + [(500, "trail ", "s"), (501, " ", "s"), (502, "  x", "s")]
    return rows


def result(df):
    return sorted((repr(r.doc_id), *[r[c] for c in token_alignment.SUMS], r.groups_sha256) for r in df.collect())


def test_equals_brute_force(spark, encoders):
    rows = corpus()
    want = sorted((repr(i), *w) for (i, _, _), w in zip(rows, brute([t for _, t, _ in rows], encoders)))
    assert result(token_alignment.digests(with_clashes(frame(spark, rows)).repartition(5))) == want
    assert any(w[1] for w in want) and any(not w[1] for w in want)


def test_blocks_of_pairs_and_branches_add_up(spark, encoders, monkeypatch):
    rows = corpus()[:120]
    docs = frame(spark, rows).repartition(9)
    once = token_alignment.aligned(docs).collect()
    monkeypatch.setattr(token_alignment, "FAN", 2)
    blocks = token_alignment.aligned(docs, pairs_at_once=150).collect()
    assert sorted(map(repr, once)) == sorted(map(repr, blocks))


def test_long_texts_go_in_slices(spark, encoders, monkeypatch):
    from threadlens.llm import token_links
    rng = random.Random(9)
    texts = [prose(rng, 4000), prose(rng, 3000) + " ▁ " + prose(rng, 10), "x" * 3000, None, ""]
    files = [open(default_path("byte_bpe_50k.json")).read(), token_alignment.default_pattern(),
             open(default_path("piece_bpe_32k.model"), "rb").read()]
    want = brute(texts, encoders)
    monkeypatch.setattr(token_alignment, "SLICE", 500)
    monkeypatch.setattr(token_links, "sliced_units", lambda t, led: __import__("threadlens.llm.units").llm.units
                        .sliced_units(t, led, 500))
    count = token_alignment.PairCounts(Links(*files, groups=False, kept=300))
    total = Counter()
    for keys, counts in [*count.add(texts), *count.flush()]:
        total.update(dict(zip(keys.tolist(), counts.tolist())))
    assert sum(total.values()) == sum(w[3] for w in want)
    measures = token_alignment.Measures(Links(*files, groups=True, kept=300), token_alignment.Lookup([]),
                                        np.zeros(40_000, np.int64))
    out = {i: (sums[:4], groups) for i, sums, groups in measures.of(texts)}
    for i, w in enumerate(want):
        assert (out[i][0] if i in out else (0, 0, 0, 0)) == w[:4]
        assert i not in out or hashlib.sha256(out[i][1].encode()).hexdigest() == w[6]


def test_empty_table(spark):
    assert token_alignment.aligned(spark.createDataFrame([], SCHEMA)).collect() == []


def test_perfect_hash_is_minimal_and_verifiable():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 5000):
        keys = np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64))
        bucket = perfect_hash.bucket_of(keys)
        function = perfect_hash.PerfectHash.of({b: perfect_hash.build(keys[bucket == b]) for b in range(256)})
        assert sorted(function.number(keys).tolist()) == list(range(len(keys)))
    assert function.words.nbytes * 8 < 20 * len(keys)
    other = function.number(rng.integers(1 << 41, 1 << 42, 1000).astype(np.uint64))
    assert (other < len(keys)).all()

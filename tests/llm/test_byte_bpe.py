import hashlib
import random

import numpy as np
import pytest
import regex
from corpus_helpers import SCHEMA, frame, odd_rows, prose, with_clashes

from threadlens.llm import byte_bpe
from threadlens.llm.units import sliced_units, units

tiktoken = pytest.importorskip("tiktoken")
ALPHABET = list("abcXYZ019 \n\t  '.,!é漢かÄ　\xa0▁\U0001f600") + ["<|endoftext|>", "'ll", "\r\n", "\x00", "\x1c", "\x85"]


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(byte_bpe.default_path())
    return tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Coder(byte_bpe.model_file(byte_bpe.read_ranks(byte_bpe.default_path())), byte_bpe.default_pattern(),
                          kept=500)


def random_texts(n=3000, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(n)]


def test_same_ids_as_rank_merging(coder, reference):
    for text in random_texts():
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), repr(text)
        assert coder.decode(ids).decode() == text


def test_units_lie_between_matches_of_the_pattern():
    split = regex.compile(byte_bpe.default_pattern()).findall
    for text in random_texts(seed=4):
        assert "".join(units(text)) == text and "".join(units(text, led=True)) == " " + text
        assert [m for u in units(text) for m in split(u)] == split(text), repr(text)
        pieces = [u for part in sliced_units(text, size=5) for u in part]
        assert [m for u in pieces for m in split(u)] == split(text), repr(text)


def test_a_token_no_join_reaches_is_still_taken_whole():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"xyz": 258}
    coder = byte_bpe.Coder(byte_bpe.model_file(ranks), byte_bpe.default_pattern())
    want = tiktoken.Encoding("t", pat_str=byte_bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})
    assert coder.whole
    for text in ("xyz", " xyz", "abc xyz abcabc", "xyzxyz"):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == want.encode_ordinary(text)
    with pytest.raises(ValueError):
        byte_bpe.model_file({b"a": 0})


def test_digests_of_a_table(spark, reference):
    rng = random.Random(5)
    rows = odd_rows() + [(100 + i, prose(rng, rng.randint(0, 200)), "s") for i in range(50)] + [(99, "y" * 300_000, "s")]
    out = byte_bpe.digests(with_clashes(frame(spark, rows))).collect()
    want = []
    for doc_id, text, _ in rows:
        ids = reference.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, want))
    assert byte_bpe.digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ids_and_bytes_round_trip(spark):
    tokens = byte_bpe.encoded(with_clashes(frame(spark, odd_rows())))
    assert "score" in tokens.columns
    for r in byte_bpe.decoded(tokens).collect():
        assert bytes(r.decoded).decode() == (r.text or "") and len(r.ids) % 4 == 0

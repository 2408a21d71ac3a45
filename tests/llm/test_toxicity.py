import random

import numpy as np
import zstandard
from corpus_helpers import SCHEMA, crc, frame, odd_rows, prose, with_clashes

from threadlens.llm import toxicity
from threadlens.llm.queries import op8_toxicity

BAD = ["vilethug", "grubface", "dolthead", "snotrag"]


def labelled(spark, n=1200):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(30, 120)).split(" ")
        bad = i % 6 == 0
        for _ in range(6 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), f"s{i % 4}"))
        labels.append((i, 1, int(bad)))
    return rows, frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_finds_planted_words_and_leaves_clean_texts(spark):
    rows, docs, labels = labelled(spark)
    out = toxicity.toxicity(docs, labels).collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) for r in out)
    assert all(r.predicted == int(r.score >= 0.7) for r in out)
    bad = [r for r in held if r.doc_id % 6 == 0]
    good = [r for r in held if r.doc_id % 6]
    assert np.mean([r.predicted for r in bad]) > 0.95
    assert np.mean([r.predicted for r in good]) < 0.02
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if not r.predicted}


def test_saved_bytes_are_compression_lengths():
    ordinary, toxic = b"the quick brown fox jumps over it " * 40, b" vilethug grubface dolthead " * 20
    d = toxicity.Distance(ordinary, toxic)
    text = "the quick brown fox jumps over it again dolthead vilethug grubface dolthead vilethug dolthead grubface vilethug"

    def size(content, window):
        z = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=z, write_content_size=False,
                                            write_checksum=False, write_dict_id=False).compress(window))
    want = [size(ordinary, w) - size(toxic + ordinary, w) for w in toxicity.windows(text)]
    assert d.saved(text).tolist() == want and max(want) > 0


def test_windows_cover_whole_texts():
    text = " ".join(str(i) for i in range(10_001))
    assert b" ".join(toxicity.windows(text)).decode() == text


def test_small_real_tables(spark):
    out = op8_toxicity(spark, "/root/testdata/sf0.01").collect()
    assert len(out) == 1000 and all(0 <= r.score <= 1 for r in out)


def test_odd_rows(spark):
    labels = spark.createDataFrame([(7, 1, 1), (8, 0, None), (None, 1, 0), (9, 1, 0), (5, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = with_clashes(frame(spark, odd_rows()))
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == len(odd_rows())
    assert len({r.score for r in out if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.toxicity(spark.createDataFrame([], SCHEMA), labels).collect() == []
    none = labels.filter("false")
    assert len(toxicity.toxicity(docs, none).collect()) == len(odd_rows())
    assert toxicity.without_toxic(docs, none).columns == docs.columns


def test_marks_of_a_small_language_are_learnt_beside_a_large_one():
    rng = random.Random(4)
    many = [f"{a}{b}word" for a in ("vile", "grub", "dolt", "snot", "muck", "yack") for b in "qxzjkvwpghf"]
    small = [f"sé{c}ô" for c in "bcdfghlmnpr"]
    toxic = [prose(rng, 60) + " " + " ".join(rng.sample(many, 20)) for _ in range(500)]
    french = [" ".join(rng.choice(small) for _ in range(60)) for _ in range(100)]
    marked = [t + " " + " ".join("réê" + rng.choice(small) for _ in range(6)) for t in french[:14]]
    cjk = ["漢字 書物 文章 " + " ".join(rng.sample("山川田木林森花鳥風月", 5)) for _ in range(100)]
    insults = [t + " 文笨蛋章" for t in cjk[:14]]
    ordinary = [prose(rng, 60) for _ in range(1500)] + french[14:] + cjk[14:]
    phrases = toxicity.toxic_phrases(toxic + marked + insults, ordinary)
    assert sum("réê".encode() in p for p in phrases) == 14
    assert sum("笨蛋".encode() in p for p in phrases) == 14
    assert not any(w in p for p in phrases for w in (b"w399", "字".encode(), "séb".encode()))


def test_ordinary_windows_come_from_all_texts_when_bounded():
    texts = [" ".join(f"t{i}n{j}" for j in range(8 * n)) for i, n in enumerate([50, 3, 400, 1, 0, 90])]
    every = [w for t in texts for w in toxicity.windows(t)]
    assert toxicity.spread_windows(texts) == every and toxicity.spread_windows(texts, len(every)) == every
    some = toxicity.spread_windows(texts, 100)
    assert len(some) == 100 == len(set(some)) and some == toxicity.spread_windows(texts, 100)
    assert set(some) <= set(every) and some != every[:100]
    per = [sum(w.startswith(b"t%dn" % i) for w in some) for i in range(6)]
    assert per == [32, 3, 32, 1, 0, 32]
    assert len(toxicity.spread_windows(texts, 2)) == 2

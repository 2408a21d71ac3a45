import random
import zlib
from collections import Counter

from corpus_helpers import SCHEMA, frame, odd_rows, prose, with_clashes

from threadlens.llm import sharding


def test_every_shard_matches_the_mixture(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(0, 30)), "hot" if i % 3 == 0 else f"s{i % 8}") for i in range(1603)]
    out = sharding.interleaved(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    source = {i: s for i, _, s in rows}
    counts = Counter(r.shard for r in out)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in range(16):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(counts[shard]))
        for s, n in Counter(source.values()).items():
            here = sum(1 for r in out if r.shard == shard and source[r.doc_id] == s)
            assert abs(here - n / 16) <= 2
    text = {i: t for i, t, _ in rows}
    for r in out[:100]:
        assert r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        assert r["size"] == len(text[r.doc_id].encode()) + 1
    again = sharding.interleaved(frame(spark, rows).repartition(7)).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in again) == sorted((r.doc_id, r.shard, r.slot) for r in out)


def test_odd_rows(spark):
    docs = with_clashes(frame(spark, odd_rows()))
    out = sharding.interleaved(docs, shards=3, keep=["shard", "n"]).collect()
    assert len(out) == len(odd_rows())
    assert {(r["size"], r.text_crc32) for r in out if r.doc_id in (1, 2)} == {(1, 0)}
    one = frame(spark, odd_rows()[:1])
    assert [r.shard for r in sharding.interleaved(one).collect()] == [0]
    assert sharding.interleaved(spark.createDataFrame([], SCHEMA)).collect() == []

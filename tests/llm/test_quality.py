import numpy as np
from corpus_helpers import SCHEMA, crc, frame, odd_rows, with_clashes

from threadlens.llm import quality
from threadlens.llm.queries import op10_quality

SF01 = "/root/testdata/sf0.01"


def test_linear_time_identity_equals_all_pairs():
    rng = np.random.default_rng(1)
    items = [(np.sort(rng.choice(quality.WORD_BUCKETS, 9, replace=False)), rng.random(len(quality.STATS)).tolist())
             for _ in range(6)]
    model = quality.fit(items, np.array([0.0, 1, 0, 1, 1, 0]), epochs=2)
    ids, x, starts = quality.gathered(items, model.cuts)
    got = quality.margin(model, ids, x, starts)
    ends = np.r_[starts[1:], len(ids)]
    for n, (a, b) in enumerate(zip(starts, ends)):
        z = model.bias + sum(model.linear[i] * v for i, v in zip(ids[a:b], x[a:b]))
        for p in range(a, b):
            for q in range(p + 1, b):
                z += model.factors[ids[p]] @ model.factors[ids[q]] * x[p] * x[q]
        assert abs(z - got[n]) < 1e-9


def test_held_out_accuracy(spark):
    out = {r.doc_id: r for r in op10_quality(spark, SF01).collect()}
    assert len(out) == 1000
    labels = spark.read.parquet(f"{SF01}/labels.parquet").collect()
    held = [r for r in labels if crc(r.doc_id) % 4 == 2]
    assert all(out[r.doc_id].held_out for r in held)
    right = [out[r.doc_id].predicted == r.quality for r in held]
    assert np.mean(right) > 0.9
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in out.values())


def test_odd_rows(spark):
    labels = spark.createDataFrame([(7, 1, 1), (8, 0, None), (None, 1, 0), (9, None, 0), (4, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = with_clashes(frame(spark, odd_rows()))
    out = quality.quality(docs, labels).collect()
    assert len(out) == len(odd_rows())
    assert len({r.score for r in out if r.doc_id in (1, 2)}) == 1
    assert quality.quality(spark.createDataFrame([], SCHEMA), labels).collect() == []
    assert len(quality.quality(docs, labels.filter("false")).collect()) == len(odd_rows())
    assert quality.only_good(docs, labels).columns == docs.columns

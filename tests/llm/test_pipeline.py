import random
from collections import Counter

from corpus_helpers import components, frame, prose

import corpus_pipeline
from threadlens.llm.common import stash


def corpus(spark, path):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(700):
        words = prose(rng, rng.randint(30, 90)).split(" ")
        if i % 7 == 0:
            for _ in range(8):
                words.insert(rng.randrange(len(words)), rng.choice(["vilethug", "grubface", "dolthead"]))
        text = " ".join(words)
        if i % 10 == 3:
            text = " ".join(w.upper() + "!!" for w in words)
        rows.append((i, text, f"s{i % 4}"))
        labels.append((i, int(i % 10 != 3), int(i % 7 == 0)))
    rows += [(1000 + i, rows[11][1] + (f" tail{i}" if i else ""), "s1") for i in range(9)]
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return rows


def test_each_stage_does_its_work(spark, tmp_path):
    path = str(tmp_path)
    rows = corpus(spark, path)
    text = {i: t for i, t, _ in rows}
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stash(stage(spark, docs, path), f"test-{name}")
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != "pack":
            assert docs.columns == columns
            assert docs.subtract(before).isEmpty()
    left = set(kept["toxicity"])
    toxic = {i for i in text if i < 700 and i % 7 == 0}
    assert len(toxic & left) < 0.1 * len(toxic)
    assert len(left) > 0.95 * (len(text) - len(toxic))
    junk = {i for i in left if i < 700 and i % 10 == 3}
    good = set(kept["quality"])
    assert len(junk & good) < 0.1 * len(junk) and len(good) > 0.95 * (len(left) - len(junk))
    want = components([(i, text[i], "") for i in good])
    assert sorted(kept["near_dedup"]) == sorted(set(want.values()))
    assert len(set(want.values())) < len(good)
    assert set(kept["mix"]) <= set(kept["near_dedup"]) and max(Counter(kept["mix"]).values()) == 2
    assert Counter(kept["pack"]) == Counter(kept["mix"])


def test_run_returns_every_packed_row(spark, tmp_path):
    corpus(spark, str(tmp_path))
    out = corpus_pipeline.run(spark, str(tmp_path))
    rows = out.collect()
    assert rows and {"doc_id", "block", "bin", "offset"} <= set(out.columns)
    bins = Counter()
    for r in rows:
        bins[(r.block, r.bin)] += r.length
    assert max(bins.values()) <= 1024

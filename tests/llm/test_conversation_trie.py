import hashlib
import random
from collections import defaultdict

import pytest
from corpus_helpers import crc
from pyspark.sql import functions as F

from threadlens.llm import conversation_trie
from threadlens.plans.compare import duckdb_connection

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = f"{len(role)}:{role}{text}"
            own[c].append((turn is not None, turn or 0, hashlib.sha256(said.encode()).hexdigest(), (role, text)))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h, base = crc(c) % 6, int(c / 100) * 100  # the remainder has the sign of c, as in SQL
        built[c] = turns if c == base else own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    totals = {}
    for path in sorted(members, key=len, reverse=True):
        leaves = sum(totals[x][0] for x in children[path]) or 1
        saved = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        totals[path] = leaves, saved + sum(totals[x][1] for x in children[path])
    return sorted((min(own_), len(path), min(members[path[:-1]]) if path else -1, len(own_), len(children[path]), *totals[path],
                   hashlib.sha256(",".join(map(str, sorted(c for c in own_ if len(built[c]) == len(path)))).encode())
                   .hexdigest()) for path, own_ in members.items())


def result(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in df.collect())


def corpus(seed, convs=180, longest=9):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(1000), convs):
        n = rng.randint(0, longest)
        first = rng.choice([["hello"], ["hello", "you"], []])
        for t in range(n):
            text = first[t] if t < len(first) else rng.choice(["a", "bb", "ccc", "", None, "é漢\U0001f600"])
            rows.append((c, t, rng.choice(["user", "bot"]) if t % 3 == 2 else "user", text))
    return rows


ODD = [(None, 0, "user", "lost"), (7, None, "user", "no turn"), (7, None, None, None), (7, 1, "user", "x"), (7, 1, "user", "x"),
       (7, 1, "a", "y"), (100, 0, "user", "hello"), (101, 0, "u", "short"), (-5, 3, "user", "minus"), (205, 0, "u", "no base")]


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(conversation_trie, "BLOCK_BITS", bits)
    rows = corpus(bits) + ODD
    frame = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("pos", "mid", "block", "k", "base")])
    assert result(conversation_trie.conversation_trie(frame.repartition(5))) == brute(rows)


def test_conversations_wider_than_the_matrix(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "WIDTH", 3)
    monkeypatch.setattr(conversation_trie, "BLOCK_BITS", 2)
    rows = corpus(5, convs=60, longest=14)
    rows += [(c, t, "user", "same") for c in (900, 911, 922, 933, 1044) for t in range(12 + (c == 922))]
    assert result(conversation_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_many_equal_conversations_and_one_long_one(spark):
    rows = [(100 * c, t, "user", f"t{t}") for c in range(6000) for t in range(2)]
    rows += [(50_000_000, t, "user", "long") for t in range(3000)]
    assert result(conversation_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table(spark):
    assert conversation_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_oracle(spark, tmp_path):
    rows = corpus(11) + ODD
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/c")
    duck = duckdb_connection("/root/testdata/sf0.001")
    duck.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    out = duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({conversation_trie.ORACLE})").fetchall()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in out) == brute(rows)

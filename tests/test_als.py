"""ALS: structure of the recommendations (no SQL oracle)."""

import math

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from threadlens.operators import recommend
from threadlens.plans import queries as Q
from threadlens.sources import fixtures


def test_als_structure(spark):
    recs = Q.als_lists(spark, SF001)[0]
    counts = recommend.interaction_counts(fixtures.load_comments(spark, SF001))
    users = counts.select("author").distinct().count()
    items = counts.select("subreddit").distinct().count()
    rows = recs.collect()
    per_user = {}
    for r in rows:
        per_user.setdefault(r.author, []).append(r)
        assert math.isfinite(r.score)
    assert len(per_user) == users
    assert all(len(v) == min(Q.ALS_TOP_N, items) for v in per_user.values())
    assert all(sorted(x.position for x in v) == list(range(1, len(v) + 1)) for v in per_user.values())


def dense_implicit_als(r, item, rank, iterations, alpha, reg):
    """Implicit ALS on a dense matrix from given item factors."""
    conf, like = alpha * np.abs(r), (r > 0).astype(float)
    for _ in range(iterations):
        for side in (0, 1):
            c, p, other = (conf, like, item) if side == 0 else (conf.T, like.T, user)
            base, out = other.T @ other, np.zeros((c.shape[0], rank))
            for n in range(c.shape[0]):
                a = base + (other * c[n][:, None]).T @ other + reg * (p[n] > 0).sum() * np.eye(rank)
                out[n] = np.linalg.solve(a, other.T @ ((1 + c[n]) * p[n]))
            if side == 0:
                user = out
            else:
                item = out
    return user, item


def test_factors_solve_the_dense_problem(spark):
    """After many iterations, one more dense step from the trained item factors
    gives the trained predictions."""
    rng = np.random.default_rng(1)
    r = np.where(rng.random((12, 9)) < 0.4, rng.integers(1, 6, (12, 9)), 0).astype(float)
    r[0, 0] = r[11, 8] = 1.0
    rows = [(int(u), int(i), float(r[u, i])) for u, i in zip(*np.nonzero(r))]
    model = recommend.train_als(spark.createDataFrame(rows, "user int, item int, rating float"), rank=3, max_iter=40,
                                alpha=1.0, reg=0.1, blocks=2)
    factors = [np.zeros((r.shape[0], 3)), np.zeros((r.shape[1], 3))]
    for out, df in zip(factors, (model.userFactors, model.itemFactors)):
        for x in df.collect():
            out[x.id] = x.features
    user, item = dense_implicit_als(r, factors[1], 3, 1, 1.0, 0.1)
    seen = r.sum(1) > 0
    assert np.abs(user @ item.T - factors[0] @ factors[1].T)[seen][:, r.sum(0) > 0].max() < 0.02


def test_top_items_equal_brute_force_with_ties(spark):
    class Model:
        userFactors = spark.createDataFrame([(u, [float(u % 3), 1.0]) for u in range(50)], "id int, features array<float>")
        itemFactors = spark.createDataFrame([(i, [float(i % 4), 0.5]) for i in range(30)], "id int, features array<float>")
    want = {u: sorted(((-(u % 3) * (i % 4) - 0.5, i) for i in range(30)))[:7] for u in range(50)}
    for rows in (4, 1000):  # many small grid cells, and one
        got = {}
        for r in recommend.als_top_items(Model, 7, grid_rows=rows).orderBy("user", "position").collect():
            got.setdefault(r.user, []).append((-r.score, r.item))
        assert got == want


def test_lists_do_not_depend_on_the_partitions(spark):
    counts = recommend.interaction_counts(fixtures.load_comments(spark, SF001)).persist()
    users, items = recommend.id_map(counts, "author", "user"), recommend.id_map(counts, "subreddit", "product")
    out = []
    for parts in (1, 7):
        model = recommend.train_als(recommend.als_ratings(counts.repartition(parts, "author")), max_iter=3)
        out.append(sorted((r.author, r.position, r.subreddit) for r in
                          recommend.als_recommend(model, users, items, 5).collect()))
    same = sum(a == b for a, b in zip(*out))
    assert len(out[0]) == len(out[1]) and same > 0.99 * len(out[0])


def test_als_same_seed_same_factors(spark):
    counts = recommend.interaction_counts(fixtures.load_comments(spark, SF001))
    ratings = recommend.als_ratings(counts)
    a = recommend.train_als(ratings, max_iter=3).userFactors.orderBy("id").collect()
    b = recommend.train_als(ratings, max_iter=3).userFactors.orderBy("id").collect()
    assert [r.features for r in a] == [r.features for r in b]


def test_ratings_ids_fit_int(spark):
    counts = recommend.interaction_counts(fixtures.load_comments(spark, SF001))
    r = recommend.als_ratings(counts).agg(F.max("user"), F.max("item"), F.min("rating")).first()
    assert r[0] < 10 ** 8 and r[1] < 10 ** 8 and r[2] >= 1.0


def test_structure_query_sees_faults(spark):
    recs = spark.createDataFrame([("a", "s1", 2.0, 1), ("a", "s2", 3.0, 2), ("b", "zz", 1.0, 1)],
                                 "author string, subreddit string, score float, position bigint")
    items = spark.createDataFrame([("s1",), ("s2",)], "product string")
    got = {(r.author, r.position): (r.known, r.ordered) for r in recommend.als_structure(recs, items).collect()}
    assert got == {("a", 1): (True, True), ("a", 2): (True, False), ("b", 1): (False, True)}

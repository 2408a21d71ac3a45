"""Recommenders: the graph recommender and implicit-feedback ALS."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions.ids import ID_MODULUS, stable_hash
from threadlens.operators.common import top_per_group
from threadlens.operators.graph import leaders
from threadlens.session import scratch_path
from threadlens.sources.fixtures import DELETED_AUTHOR

# Fixed values of the reference recommender: list length and ALS settings.
RECOMMENDATIONS = 6
ALS_RANK = 10
ALS_ITERATIONS = 10
ALS_ALPHA = 0.01
ALS_REG = 0.01
ALS_SEED = 5


def interaction_counts(comments: DataFrame) -> DataFrame:
    """(author, subreddit, count) for known authors; the author filter runs
    before the partial aggregation and reaches the scan."""
    return (comments.filter(F.col("author") != F.lit(DELETED_AUTHOR))
            .groupBy("author", "subreddit").agg(F.count(F.lit(1)).alias("count")))


def id_map(counts: DataFrame, column: str, name: str, modulus: int = ID_MODULUS) -> DataFrame:
    """Distinct (name, hash) pairs of one column of the counts."""
    return (counts.select(F.col(column).alias(name)).distinct()
            .select(name, stable_hash(name, modulus).alias("hash")))


def hash_audit(names: DataFrame, name: str, modulus: int = ID_MODULUS) -> DataFrame:
    """Hashes shared by more than one name (collisions merge in ALS)."""
    return (names.select(F.col(name).alias("name")).distinct()
            .groupBy(stable_hash("name", modulus).alias("hash"))
            .agg(F.count(F.lit(1)).alias("names"), F.min("name").alias("first_name"),
                 F.max("name").alias("last_name"))
            .filter(F.col("names") > 1))


def _sample_key(owner: str, item: str):
    """Repeatable sampling order of an item within its owner's list."""
    return F.md5(F.concat_ws("|", F.col(owner), F.col(item)))


def graph_recommend(comments: DataFrame, edges: DataFrame, block_list: DataFrame | None = None,
                    k: int = RECOMMENDATIONS, by: str = "outdegree",
                    cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Up to ``k`` subreddits for every subreddit, from its leading user.

    For each seed subreddit take its leader (top out-degree by default, or
    in-degree), the distinct subreddits the leader posts in, minus block-listed
    names and minus the seed, and keep ``k`` in a repeatable pseudo-random order
    (md5 of leader and subreddit).

    Scale: the order depends on the user, not on the seed, so every user's
    list is cut to ``k + 1`` once (a partial WindowGroupLimit per map task,
    then a final one) before it meets the seeds; a user leading many
    subreddits therefore costs at most ``k + 1`` rows per seed, never
    seeds x subreddits.  Only the leaders' comments (one author per subreddit
    at most) pass the semi-join and are made distinct.  The leaders are used
    twice: ``cut`` (such as a write to shared storage) keeps the reply graph
    behind them from being computed twice.
    """
    seeds = leaders(edges, by).select(F.col("subreddit").alias("seed"), F.col("author").alias("leader"))
    if cut is not None:
        seeds = cut(seeds)
    pairs = (comments.select(F.col("author").alias("leader"), "subreddit")
             .join(seeds.select("leader").distinct(), "leader", "left_semi").distinct())
    if block_list is not None:
        # a plain join: whether the list is small enough to broadcast is AQE's measurement
        pairs = pairs.join(block_list.select(F.col(block_list.columns[0]).alias("subreddit")), "subreddit", "left_anti")
    shortlist = top_per_group(pairs.withColumn("_key", _sample_key("leader", "subreddit")),
                              ["leader"], [F.col("_key"), F.col("subreddit")], k + 1)
    cands = (seeds.join(shortlist, "leader", "inner")
             .filter(F.col("subreddit") != F.col("seed")))
    return top_per_group(cands, ["seed"], [F.col("_key"), F.col("subreddit")], k,
                         position="position").select("seed", "leader", "subreddit", "position")


def als_ratings(counts: DataFrame, modulus: int = ID_MODULUS) -> DataFrame:
    """(user, item, rating) with md5-derived integer ids; colliding names
    share an id, as in the hashed ids of the original recommender."""
    return counts.select(stable_hash("author", modulus).cast("int").alias("user"),
                         stable_hash("subreddit", modulus).cast("int").alias("item"),
                         F.col("count").cast("float").alias("rating"))


def dense_ids(names: DataFrame, name: str, stored: DataFrame | None = None) -> DataFrame:
    """(name, id): distinct names numbered 0 to n - 1 without gaps or collisions.

    The names are range-partitioned and sorted; a row's number is its place in
    its partition plus the rows of the partitions before, so only a count per
    partition meets in one place and no name is collected.  Names in ``stored``
    (an earlier result) keep their ids, and new ones follow in name order, so a
    trained model stays valid.  A null name has no id."""
    spark = names.sparkSession
    fresh = names.select(F.col(name).cast("string").alias(name)).filter(F.col(name).isNotNull()).distinct()
    start = 0
    if stored is not None:
        start = (stored.agg(F.max("id")).first()[0] or 0) + 1 if not stored.isEmpty() else 0
        fresh = fresh.join(stored.select(name), name, "left_anti")
    path = scratch_path(spark, "dense-ids")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fresh.repartitionByRange(n, name).sortWithinPartitions(name) \
        .withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("__part", F.shiftright("__at", 33))
    parts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # a row per partition
    parts = parts.select("__part", F.coalesce(F.sum("__n").over(
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    ids = placed.join(F.broadcast(parts), "__part").select(
        name, (F.lit(start) + F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).alias("id"))
    return ids if stored is None else stored.select(name, "id").unionByName(ids)


def dense_ratings(counts: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """(user, item, rating) over dense ids: no two names share a row of factors."""
    return counts.join(users.withColumnRenamed("id", "__u"), "author") \
        .join(items.withColumnRenamed("id", "__i"), "subreddit") \
        .select(F.col("__u").cast("int").alias("user"), F.col("__i").cast("int").alias("item"),
                F.col("count").cast("float").alias("rating"))


#: User and item blocks of the training.  The initial factors are drawn per
#: block, so this number is part of the model: it is a job parameter and never
#: follows the cluster's size.
ALS_BLOCKS = 10


def train_als(ratings: DataFrame, rank: int = ALS_RANK, max_iter: int = ALS_ITERATIONS,
              alpha: float = ALS_ALPHA, reg: float = ALS_REG, seed: int = ALS_SEED,
              blocks: int = ALS_BLOCKS):
    """Implicit-feedback ALS (``pyspark.ml``).  Factor blocks are partitioned by
    id; lineage is cut every ``checkpointInterval`` iterations into the
    session's checkpoint folder."""
    from pyspark.ml.recommendation import ALS
    als = ALS(rank=rank, maxIter=max_iter, alpha=alpha, regParam=reg, seed=seed, implicitPrefs=True,
              userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop",
              checkpointInterval=5, numUserBlocks=blocks, numItemBlocks=blocks)
    return als.fit(ratings)


def gram(factors: DataFrame, rank: int) -> np.ndarray:
    """The sum of all factors' outer products: rank x rank numbers, added up by
    Spark in double precision."""
    f = F.col("features")
    pairs = [(i, j) for i in range(rank) for j in range(i, rank)]
    row = factors.agg(*[F.sum(f[i].cast("double") * f[j].cast("double")) for i, j in pairs]).first()
    out = np.zeros((rank, rank))
    for (i, j), value in zip(pairs, row):
        out[i, j] = out[j, i] = value or 0.0
    return out


def fold_in(item_factors: DataFrame, ratings: DataFrame, rank: int = ALS_RANK, alpha: float = ALS_ALPHA,
            reg: float = ALS_REG) -> DataFrame:
    """(id, features) of the users in ``ratings`` (user, item, rating), known to
    the model or not, from the stored item factors: the training's own last
    step, without training again.

    A user's normal equations are the items' Gram matrix plus sums over the
    user's own items.  Those are rank * (rank + 3) / 2 partially aggregated
    numbers per user, so a user with a third of all ratings is one row per map
    task; only the solving of finished equations runs in Python.  A user none
    of whose items is known has no row.
    """
    yty = gram(item_factors, rank)
    rows = ratings.filter("rating > 0").join(item_factors.withColumnRenamed("id", "item"), "item")
    c = F.lit(alpha) * F.col("rating").cast("double")
    y = [F.col("features")[i].cast("double") for i in range(rank)]
    pairs = [(i, j) for i in range(rank) for j in range(i, rank)]
    sums = rows.groupBy("user").agg(
        F.array(*[F.sum(c * y[i] * y[j]) for i, j in pairs]).alias("a"),
        F.array(*[F.sum((1 + c) * v) for v in y]).alias("b"), F.count(F.lit(1)).alias("n"))

    @F.pandas_udf("array<float>")
    def solved(a: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
        upper, right = np.stack(a.to_numpy()), np.stack(b.to_numpy())
        left = np.zeros((len(upper), rank, rank))
        for at, (i, j) in enumerate(pairs):
            left[:, i, j] = left[:, j, i] = upper[:, at]
        left += yty + (reg * n.to_numpy())[:, None, None] * np.eye(rank)
        return pd.Series(list(np.linalg.solve(left, right[:, :, None])[:, :, 0].astype(np.float32)))
    return sums.select(F.col("user").alias("id"), solved("a", "b", "n").alias("features"))


#: Factors per block of the scoring grid: a cell holds two such blocks, and
#: scores this many cells of the matrix at once.
ALS_GRID_ROWS = 16_384
ALS_SCORE_CELLS = 1 << 22


def _blocked(factors: DataFrame, seed: int, rows: int) -> tuple[DataFrame, int]:
    n = max(1, -(-factors.count() // rows))
    return factors.select("id", "features", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n)).cast("int").alias("b")), n


def als_top_items(model, n: int, grid_rows: int = ALS_GRID_ROWS) -> DataFrame:
    """(user, item, score, position): the ``n`` best items of every user, ties
    by item.

    Exact top-n has to score every user against every item.  Both factor
    tables are dealt into blocks of about ``grid_rows`` rows; each pair of
    blocks meets in one task, which keeps ``n`` rows per user, and a window
    merges them.  Memory is bounded by the block size, and no table passes the
    driver.  Scores are summed in double precision, so they do not depend on
    how the grid is cut.
    """
    users, nu = _blocked(model.userFactors, 1, grid_rows)
    items, ni = _blocked(model.itemFactors, 2, grid_rows)
    left = users.select("id", "features", F.col("b").alias("ub"), F.explode(F.sequence(F.lit(0), F.lit(ni - 1))).alias("ib"))
    right = items.select("id", "features", F.explode(F.sequence(F.lit(0), F.lit(nu - 1))).alias("ub"), F.col("b").alias("ib"))

    def cell(u: pd.DataFrame, i: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(u) and len(i):
            i = i.sort_values("id")
            ids, mat = i["id"].to_numpy(), np.stack(i["features"].to_numpy()).astype(np.float64)
            k, step = min(n, len(ids)), max(1, ALS_SCORE_CELLS // len(ids))
            for lo in range(0, len(u), step):
                part = u.iloc[lo:lo + step]
                vec = np.stack(part["features"].to_numpy()).astype(np.float64)
                score = sum(vec[:, f:f + 1] * mat[None, :, f] for f in range(mat.shape[1])).astype(np.float32)
                best = np.argsort(-score, axis=1, kind="stable")[:, :k]  # equal scores stay in item order
                out.append(pd.DataFrame({"user": np.repeat(part["id"].to_numpy(), k), "item": ids[best].ravel(),
                                         "score": np.take_along_axis(score, best, 1).ravel()}))
        return pd.concat(out) if out else pd.DataFrame({"user": [], "item": [], "score": []})

    found = left.groupBy("ub", "ib").cogroup(right.groupBy("ub", "ib")).applyInPandas(
        cell, "user int, item int, score float")
    return top_per_group(found, ["user"], [F.col("score").desc(), F.col("item")], n, position="position")


def als_recommend(model, users: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Top-``n`` items for every user, mapped back to names.  Hash collisions
    make a name map to several ids and back, exactly as in the hashed
    original."""
    u = users.select(F.col("user").alias("user_name"), F.col("hash").cast("int").alias("user"))
    i = items.select(F.col("product").alias("subreddit"), F.col("hash").cast("int").alias("item"))
    return (als_top_items(model, n).join(u, "user").join(i, "item")
            .select(F.col("user_name").alias("author"), "subreddit", "score", "position"))


def als_structure(recs: DataFrame, items: DataFrame) -> DataFrame:
    """(author, position, known, ordered): every recommendation's place, that
    its subreddit is a known item and its score a number not above the one
    before it.  What can be said of a learnt list without its scores."""
    w = Window.partitionBy("author").orderBy("position")
    named = recs.join(items.select(F.col("product").alias("subreddit"), F.lit(True).alias("known")), "subreddit", "left")
    ordered = F.coalesce(F.col("score") <= F.lag("score").over(w), F.lit(True)) & ~F.isnan("score")
    return named.select("author", "position", F.coalesce("known", F.lit(False)).alias("known"), ordered.alias("ordered"))

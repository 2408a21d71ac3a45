"""Helpers shared by the operators: deterministic top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                  position: str | None = None) -> DataFrame:
    """The first ``k`` rows of every group under a total order.

    ``row_number() <= k`` lets Spark plan a partial ``WindowGroupLimit`` before
    the shuffle, so a group holding a third of all rows sends at most ``k``
    rows per map task to the exchange.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    col = position or "__pos"
    out = df.withColumn(col, F.row_number().over(w)).filter(F.col(col) <= k)
    if position:
        return out.withColumn(position, F.col(position).cast("bigint"))
    return out.drop(col)

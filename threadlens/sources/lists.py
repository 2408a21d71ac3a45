"""Line-per-name list files (subreddit list, block list)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_name_list(spark: SparkSession, path: str, column: str = "name") -> DataFrame:
    """Trimmed, non-empty, distinct lines of a text file."""
    return (spark.read.text(path)
            .select(F.trim("value").alias(column))
            .filter(F.col(column) != "")
            .distinct())


def write_name_list(names: DataFrame, path: str, column: str = "name") -> None:
    names.select(F.col(column).alias("value")).write.mode("overwrite").text(path)

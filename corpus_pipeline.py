"""A training-data pipeline over ``documents``: five stages, each one operator
of ``threadlens.llm``.  Every stage's result is written as Parquet under
``spark.checkpoint.dir`` and read again as the next one's ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlens.llm import mixing, near_dup, packing, quality, toxicity
from threadlens.llm.common import stash, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance scores toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not score good go."""
    return quality.only_good(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one of smallest id."""
    return near_dup.one_per_group(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for every repetition taken."""
    return mixing.mixed(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of the mixture in a bin; repetitions of a document are one
    cluster, so no bin holds two of them."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_dedup", dedup_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]

#: Learnt models and best-fit packing have no SQL form; the stages are tested
#: one by one against brute force (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Each stage but the last is written and
    read again, so a lost executor repeats one stage at most."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stash(docs, f"stage-{name}")
    return docs

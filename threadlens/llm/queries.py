"""Registered queries of the corpus operators: each applies its operator with
production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlens.llm import (
    byte_bpe,
    conversation_trie,
    fingerprints,
    language,
    mixing,
    near_dup,
    packing,
    quality,
    search,
    sharding,
    token_alignment,
    toxicity,
    url_filter,
)
from threadlens.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capped water-filling mix of all documents."""
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into bins without conflicts of source or cluster."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of the same mixture."""
    return sharding.interleaved(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language.languages(table(spark, sf_dir, "documents"))


def op7_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 20."""
    docs = table(spark, sf_dir, "documents")
    return search.top_k(docs, docs.filter("doc_id % 20 = 0"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return url_filter.judged_urls(table(spark, sf_dir, "pages")).drop("score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenizers aligned on every document, with corpus-wide pair counts."""
    return token_alignment.digests(table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by a byte-level BPE vocabulary."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_packing, op3_near_dup, op4_sharding, op5_fingerprints, op6_language, op7_search, op8_toxicity,
    op9_url_filter, op10_quality, op11_trie, op12_alignment, op13_byte_bpe)}

#: Learnt models, sketches, packing and ranked search have no SQL form; they
#: are tested against brute force, round trips and held-out rows.
ORACLE = {"op1_mixing": mixing.ORACLE, "op3_near_dup": near_dup.ORACLE, "op4_sharding": sharding.ORACLE,
          "op11_trie": conversation_trie.ORACLE}

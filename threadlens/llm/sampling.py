"""Held-out splits and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import hash60

#: Labelled texts longer than this many bytes are not used for *fitting*
#: (every text is scored whole), which bounds a sample's bytes.
FIT_TEXT_BYTES = 65_536


def remainder(divisor: int, doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod ``divisor``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor, F.lit(-1))


def held_out(divisor: int, rest: int) -> Column:
    return remainder(divisor) == rest


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, seed: str,
                    most: dict) -> list[tuple]:
    """At most ``most[value]`` (text, value) pairs of each value of ``label``,
    in a seeded hash order.  ``labels`` has doc_id and ``label`` and holds only
    rows that may be learnt from.

    The label rows are thinned by a hash threshold before they meet the texts,
    so at most about ``sum(most.values())`` texts, each of at most
    ``FIT_TEXT_BYTES``, reach the driver.
    """
    usable = labels.select(F.col("doc_id").alias("__id"), F.col(label).alias("__label"),
                           hash60(seed, F.col("doc_id").cast("string")).alias("__h")) \
        .filter(F.col("__id").isNotNull() & F.col("__label").isin(list(most)))
    counts = {r["__label"]: r["count"] for r in usable.groupBy("__label").count().collect()}
    chosen = F.lit(False)
    for value, bound in most.items():
        share = min(1.0, 1.2 * bound / max(1, counts.get(value, 0)))
        chosen = chosen | ((F.col("__label") == value) & (F.col("__h") <= int(share * ((1 << 60) - 1))))
    ids = usable.filter(chosen).dropDuplicates(["__id"])
    rows = docs.select("doc_id", "text").filter(F.octet_length("text") <= FIT_TEXT_BYTES) \
        .join(F.broadcast(ids), F.col("doc_id") == F.col("__id")).select("__h", "__id", "text", "__label").collect()
    out, taken = [], dict.fromkeys(most, 0)
    for _, _, text, value in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if taken[value] < most[value]:
            taken[value] += 1
            out.append((text, value))
    return out

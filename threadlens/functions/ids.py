"""Identifier helpers: base-36 comment codes, "fullname" prefixes, stable hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the comment data model: fullname prefixes of a comment and of
# a submission, and the modulus of the integer ids handed to ALS.
COMMENT_PREFIX = "t1_"
SUBMISSION_PREFIX = "t3_"
ID_MODULUS = 10 ** 8


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def base36_to_long(col) -> Column:
    """``int(id, 36)``: the ordering code of a comment id."""
    return F.conv(_c(col), 36, 10).cast("bigint")


def long_to_base36(col) -> Column:
    return F.lower(F.conv(_c(col), 10, 36))


def fullname(prefix: str, col) -> Column:
    return F.concat(F.lit(prefix), _c(col))


def strip_fullname(col, prefix: str = SUBMISSION_PREFIX) -> Column:
    """Text after the first ``prefix`` up to the next one (NULL when absent)."""
    return F.try_element_at(F.split(_c(col), prefix), F.lit(2))


def link_url(link_id, base: str) -> Column:
    """Discussion URL of a submission fullname."""
    return F.concat(F.lit(base), strip_fullname(link_id))


def stable_hash(col, modulus: int = ID_MODULUS) -> Column:
    """Integer id of a name: first 8 hex digits of its md5, modulo ``modulus``.

    Reproducible across engines and runs (unlike a process-salted ``hash``);
    collisions are possible and are reported by ``recommend.hash_audit``.
    """
    return F.conv(F.substring(F.md5(_c(col)), 1, 8), 16, 10).cast("bigint") % F.lit(modulus)

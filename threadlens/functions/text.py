"""Small text helpers for page titles and list files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern that extracts an HTML page title.
TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def html_title(html) -> Column:
    """Inner text of the first ``<title>`` element ('' when missing)."""
    return F.regexp_extract(_c(html), TITLE_PATTERN, 1)


def title_head(title) -> Column:
    """Title up to its first ``:`` (whole title when there is none)."""
    return F.substring_index(_c(title), ":", 1)

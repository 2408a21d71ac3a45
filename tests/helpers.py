"""Hand-made comment rows for unit tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlens.sources.schema import COMMENT_COLUMNS, RAW_COMMENT_SCHEMA

TYPES = {f.name: f.dataType.simpleString() for f in RAW_COMMENT_SCHEMA.fields}
TYPES["created_utc"] = "bigint"
SCHEMA = ", ".join(f"{c} {TYPES[c]}" for c in COMMENT_COLUMNS)

DEFAULTS = dict(archived=False, author_flair_css_class=None, controversiality=0, distinguished=None,
                downs=0, edited="false", gilded=0, retrieved_on=0, score=1, score_hidden=False,
                subreddit_id=None, ups=1)


def comment(id, author, subreddit="s", created_utc=1704067200, parent_id=None, link_id="t3_a",
            body="b", **kw):
    row = dict(DEFAULTS, id=id, author=author, subreddit=subreddit, created_utc=created_utc,
               parent_id=parent_id or link_id, link_id=link_id, body=body, name="t1_" + id)
    row.update(kw)
    return row


def comments_df(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(c) for c in COMMENT_COLUMNS) for r in rows], SCHEMA)

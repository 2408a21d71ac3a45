"""Declared schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw comment as it appears in a monthly JSON dump; every field nullable and
# ``created_utc`` still a string.
# The field names and types of a comment dump.
RAW_COMMENT_SCHEMA = T.StructType([
    T.StructField("archived", T.BooleanType()),
    T.StructField("author", T.StringType()),
    T.StructField("author_flair_css_class", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("controversiality", T.LongType()),
    T.StructField("created_utc", T.StringType()),
    T.StructField("distinguished", T.StringType()),
    T.StructField("downs", T.LongType()),
    T.StructField("edited", T.StringType()),
    T.StructField("gilded", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("link_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("retrieved_on", T.LongType()),
    T.StructField("score", T.LongType()),
    T.StructField("score_hidden", T.BooleanType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("subreddit_id", T.StringType()),
    T.StructField("ups", T.LongType()),
])

# Typed comments: same fields, created_utc cast to bigint and moved last.
COMMENT_COLUMNS = [f.name for f in RAW_COMMENT_SCHEMA.fields if f.name != "created_utc"] + ["created_utc"]

CORRUPT_COLUMN = "_corrupt_record"

# One live comment as published to the message stream.
STREAM_RECORD_SCHEMA = T.StructType([
    T.StructField("author", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("link_url", T.StringType()),
    T.StructField("created_utc", T.LongType()),
    T.StructField("body", T.StringType()),
])

STREAM_PARSE_SCHEMA = T.StructType(STREAM_RECORD_SCHEMA.fields + [
    T.StructField(CORRUPT_COLUMN, T.StringType())])

# A polled listing page: data.children[].data is one comment.
FEED_COMMENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("link_id", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("created_utc", T.LongType()),
])

FEED_PAGE_SCHEMA = T.StructType([
    T.StructField("page", T.LongType()),
    T.StructField("polled_at", T.LongType()),
    T.StructField("data", T.StructType([
        T.StructField("children", T.ArrayType(T.StructType([
            T.StructField("kind", T.StringType()),
            T.StructField("data", FEED_COMMENT_SCHEMA)]))),
    ])),
])

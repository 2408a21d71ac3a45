"""Dumps whose fields change over the years.

A line is parsed once more as a VARIANT, which keeps every field whatever the
declared schema says.  The typed columns stay as they are; a field that the
schema lacks is read by its path, with a cast that gives NULL where it does not
fit, and a report says which unknown fields each dump has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.sources.json_source import table_name_of
from threadlens.sources.schema import COMMENT_COLUMNS, CORRUPT_COLUMN, RAW_COMMENT_SCHEMA

DOC = "doc"


def read_with_variant(spark: SparkSession, path: str) -> DataFrame:
    """Typed comments with ``doc`` (the whole line as VARIANT) and
    ``source_file``; a line that is no JSON object is left to ``dead_letters``."""
    schema = T.StructType([*RAW_COMMENT_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    lines = spark.read.text(path).select(
        F.from_json("value", schema, options).alias("r"), F.try_parse_json("value").alias(DOC),
        table_name_of(F.input_file_name()).alias("source_file"))
    raw = lines.filter(F.col(f"r.{CORRUPT_COLUMN}").isNull() & F.col(DOC).isNotNull())
    typed = {"created_utc": F.col("r.created_utc").try_cast("bigint")}
    return raw.select(*[typed.get(c, F.col(f"r.{c}")).alias(c) for c in COMMENT_COLUMNS], DOC, "source_file")


def field(path: str, kind: str) -> Column:
    """The field at a JSON path of the stored document, NULL where it is absent
    or of another kind."""
    return F.try_variant_get(F.col(DOC), path, kind)


def unknown_fields(rows: DataFrame) -> DataFrame:
    """(source_file, field, kind, rows): top-level fields that the declared
    schema lacks, counted per dump by partial aggregation."""
    known = [f.name for f in RAW_COMMENT_SCHEMA.fields]
    rows.select("source_file", DOC).createOrReplaceTempView("__drift")
    fields = rows.sparkSession.sql(
        f"SELECT source_file, key AS field, schema_of_variant(value) AS kind FROM __drift, LATERAL variant_explode({DOC})")
    return fields.filter(~F.col("field").isin(known)).groupBy("source_file", "field", "kind") \
        .agg(F.count(F.lit(1)).alias("rows"))

"""Order-insensitive comparison of a Spark result with its DuckDB oracle
(columns sorted by name, floats rounded), as the correctness gate does."""

from __future__ import annotations

import math
from collections import Counter

VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings "
         "pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{sf_dir}/{v}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rows_of(d_cols, rel.fetchall())
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    out["values_match"] = out["columns_match"] and Counter(s_rows) == Counter(d_rows)
    if not out["values_match"]:
        only_s = list((Counter(s_rows) - Counter(d_rows)).elements())[:3]
        only_d = list((Counter(d_rows) - Counter(s_rows)).elements())[:3]
        out["sample_spark_only"], out["sample_oracle_only"] = only_s, only_d
        out["spark_columns"], out["oracle_columns"] = s_cols, d_cols
    return out

"""Physical-plan checks: what a reviewer looks for in ``explain("formatted")``."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def explain_string(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def python_nodes(df: DataFrame) -> list[str]:
    """Python evaluation nodes in the plan (none expected in this package)."""
    plan = explain_string(df, "extended")
    return [n for n in PYTHON_NODES if n in plan]


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*)\]\s*$", explain_string(df), flags=re.M)


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", explain_string(df))


def count_nodes(df: DataFrame, node: str) -> int:
    """Occurrences of an operator in the physical plan tree (formatted mode
    lists each node once in its header)."""
    text = explain_string(df, "formatted")
    header = text.split("\n\n")[0]
    return len(re.findall(rf"\b{re.escape(node)}\b", header))

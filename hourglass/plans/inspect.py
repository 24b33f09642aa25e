"""Plan inspection through ``DataFrame.explain`` (what a user reads)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_section(df: DataFrame) -> str:
    """The node tree at the top of the formatted plan (before the details)."""
    text = plan_text(df, "formatted")
    return text.split("\n\n\n", 1)[0]


def count_nodes(df: DataFrame, node: str) -> int:
    return len(re.findall(rf"\b{node}\b", physical_section(df)))


def uses_python(df: DataFrame) -> bool:
    t = plan_text(df, "extended")
    return any(n in t for n in PYTHON_NODES)


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_text(df, "formatted"))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df, "formatted"))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*>)", plan_text(df, "formatted"))

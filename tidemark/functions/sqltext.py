"""Filter text, checked by Spark's own parser and analyser."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from tidemark.functions.params import markers

_QUOTED = re.compile(r"""'(?:[^']|'')*'|"(?:[^"]|"")*"|`[^`]*`""")


def balanced(text: str) -> bool:
    """Whether parentheses outside quotes open before they close."""
    depth = 0
    for char in _QUOTED.sub("", text):
        depth += {"(": 1, ")": -1}.get(char, 0)
        if depth < 0:
            return False
    return depth == 0


def where(df: DataFrame, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows of `df` where `text`, exactly one boolean expression over its columns, is true.

    Spark reads a dangling keyword as an alias (`x = 1 AND`) and a statement in parentheses as a subquery. Following
    `true AND` inside parentheses, neither parses.
    """
    if not text.strip() or ";" in _QUOTED.sub("", text) or "\x00" in text or not balanced(text):
        raise ValueError(f"Invalid SQL filter: {text!r}")
    view = f"filtered_{uuid.uuid4().hex}"

    def apply(condition: str) -> DataFrame:
        if not args:
            return df.filter(condition)
        return df.sparkSession.sql(f"SELECT * FROM {view} WHERE {condition}", args=dict(args))

    if args:
        df.createOrReplaceTempView(view)
    try:
        apply(f"(true AND {markers(text)})")
        return apply(f"({markers(text)})")
    except AnalysisException as error:
        raise ValueError(f"Invalid SQL filter: {text!r}") from error
    finally:
        if args:
            df.sparkSession.catalog.dropTempView(view)

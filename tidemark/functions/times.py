"""Time helpers that stay inside Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strptime directives and the Spark datetime letters of the same meaning.
STRPTIME = {
    "Y": "yyyy",
    "y": "yy",
    "m": "MM",
    "b": "MMM",
    "B": "MMMM",
    "d": "dd",
    "j": "DDD",
    "a": "EEE",
    "A": "EEEE",
    "H": "HH",
    "I": "hh",
    "p": "a",
    "M": "mm",
    "S": "ss",
    "f": "SSSSSS",
    "z": "xx",
    "Z": "VV",
    "%": "%",
}


def spark_pattern(strptime: str) -> str:
    """`%Y%m%d %H:%M` as a Spark datetime pattern; letters that are no directive are quoted."""
    parts, i = [], 0
    while i < len(strptime):
        char = strptime[i]
        if char == "%":
            directive = strptime[i + 1 : i + 2]
            if directive not in STRPTIME:
                raise ValueError(f"unknown time directive: %{directive}")
            parts.append(STRPTIME[directive])
            i += 2
            continue
        parts.append(f"'{char}'" if char.isalpha() else "''" if char == "'" else char)
        i += 1
    return "".join(parts)


def whole_minutes(start: Column, end: Column) -> Column:
    """Whole minutes from `start` to `end`, cut toward zero."""
    return F.timestamp_diff("MINUTE", start, end)

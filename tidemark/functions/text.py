"""Text helpers built from Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Page parts without text, and the named entities that are decoded (`&amp;` last).
SILENT_PARTS = ("script", "style")
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def before_marker(text: Column, marker: str) -> Column:
    """The text before the first `marker`, or all of it."""
    return F.substring_index(text, marker, 1)


def page_text(html: Column) -> Column:
    """Readable text of a web page: scripts, styles, comments and tags removed, entities decoded, blanks collapsed."""
    text = html
    for part in SILENT_PARTS:
        text = F.regexp_replace(text, f"(?is)<{part}[^>]*>.*?</{part}>", " ")
    text = F.regexp_replace(text, "(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, "<[^>]*>", " ")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, "[ \\t\\r\\n]+", " "))


def named_groups(text: Column, pattern: str, names: list[str]) -> list[Column]:
    """One column per capture group of `pattern`, which must match the whole text; null where it does not."""
    whole = f"^(?:{pattern})$"
    return [
        F.when(text.rlike(whole), F.regexp_extract(text, whole, i + 1)).alias(name) for i, name in enumerate(names)
    ]

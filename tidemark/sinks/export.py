"""Exports of a query result: Parquet, CSV with header, JSON lines, and a JSON array for capped results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

FORMATS = ("parquet", "csv", "jsonl", "json")


def export(df: DataFrame, path: str, fmt: str, limit: int | None = None) -> str:
    """Write `df` below `path`, one file per partition; returns `path`.

    A JSON array is one document, so it needs a `limit`; use `jsonl` for results of any size.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; choose one of {', '.join(FORMATS)}")
    if limit is not None:
        df = df.limit(limit)
    if fmt == "parquet":
        df.write.parquet(path)
    elif fmt == "csv":
        df.write.option("header", True).option("nullValue", "").option("emptyValue", '""').csv(path)
    elif fmt == "jsonl":
        df.write.option("ignoreNullFields", False).json(path)
    else:
        if limit is None:
            raise ValueError("a JSON array is a single document and needs a limit; use jsonl")
        _json_array(df).write.text(path)
    return path


def _json_array(df: DataFrame) -> DataFrame:
    """The capped rows as one text value holding a JSON array."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.agg(F.concat(F.lit("["), F.array_join(F.collect_list(row), ","), F.lit("]")).alias("value"))


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def dry_run(df: DataFrame) -> None:
    """Execute the whole plan and write nothing."""
    df.write.format("noop").mode("overwrite").save()


def preview(df: DataFrame, mode: str = "head", rows: int = 10, key: list[str] | None = None) -> DataFrame | None:
    """`off`, `on` and `head` (first rows) or `tail` (last rows along `key`; Spark rows have no order of their own)."""
    if mode == "off":
        return None
    if mode in ("on", "head"):
        ordered = df.orderBy(*key) if key else df
        return ordered.limit(rows)
    if mode == "tail":
        if not key:
            raise ValueError("a tail preview needs a key to order by")
        return df.orderBy(*[F.col(name).desc() for name in key]).limit(rows).orderBy(*key)
    raise ValueError(f"unknown preview mode {mode!r}")


def profile(df: DataFrame) -> list[tuple[str, str, bool]]:
    """Column names with types and nullability, as a preview shows them."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]


def scratch_export(df: DataFrame, fmt: str, limit: int | None = None) -> str:
    return export(df, scratch_path(df.sparkSession, f"export-{fmt}"), fmt, limit)

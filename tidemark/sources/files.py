"""Reading and listing files: formats, globs, hive-style folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "csv", "jsonl")


def read_files(
    spark: SparkSession, patterns: str | Sequence[str], fmt: str = "parquet", schema: str | None = None
) -> DataFrame:
    """Files matching one or many globs. Give CSV and JSON lines a `schema` to spare the inference pass."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; choose one of {', '.join(FORMATS)}")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [patterns] if isinstance(patterns, str) else list(patterns)
    if fmt == "csv":
        return reader.option("header", True).option("inferSchema", schema is None).csv(paths)
    return reader.json(paths) if fmt == "jsonl" else reader.parquet(*paths)


def read_prefix(spark: SparkSession, root: str, *prefixes: str) -> DataFrame:
    """Some folders of a hive-style layout, with the folder values (`year=2024/month=1`) as columns."""
    paths = [f"{root.rstrip('/')}/{prefix}" for prefix in prefixes] or [root]
    return spark.read.option("basePath", root).parquet(*paths)


def list_files(spark: SparkSession, patterns: str | Sequence[str], suffix: str = "*.parquet") -> DataFrame:
    """Paths, sizes and times of the files below the globs; no content is read."""
    paths = [patterns] if isinstance(patterns, str) else list(patterns)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", suffix)
        .option("recursiveFileLookup", True)
        .load(paths)
        .select(F.col("path"), F.col("length"), F.col("modificationTime").alias("modified"))
    )

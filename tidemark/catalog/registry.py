"""The named queries and, for each one SQL can state, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path, tune

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables as attributes, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def query(sql: str | None = None) -> Callable:
    """Register a function of `Tables` under its own name, with its SQL counterpart if there is one."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(tune(spark), folder))

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return run

    return register

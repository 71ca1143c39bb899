"""Intermediate tables in the shared folder that an operator removes once nothing reads them any more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path


class Scratch:
    """Writes tables and remembers where; `clear` deletes just those."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def lay(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, keep: int = 0) -> None:
        """Delete all tables but the last `keep`."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        gone = self.paths[: len(self.paths) - keep]
        self.paths = self.paths[len(gone) :]
        for name in gone:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)

"""Structured Streaming variants: file import, windowed statistics, dedupe, change merge and audit.

Every sink is idempotent per batch: a batch writes to the folder of its own number, so a batch repeated after a failure
replaces what it wrote before. Queries stop by themselves with `availableNow`.

Where a target keeps state, its batches are folded: once FOLD_EVERY of them wait, they and the base so far are reduced to a new
base. A base counts from the moment its record is renamed into place, and the record names the last batch in it. A fold that dies
before that leaves a folder that nothing names; one repeated after it finds its batches folded. So each batch is in the base or still
waits, never both, and a read touches the base and the waiting batches only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.diffs import apply_changes, latest_changes
from tidemark.operators.quality import Check, run_suite
from tidemark.operators.reports import keep_best

# Batches that wait before they are folded into the base.
FOLD_EVERY = 8
STATS = ["n", "total", "mean", "lowest", "highest"]


def file_stream(
    spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Files as they arrive below `path`; without a `schema` that of the files already there is taken.

    A stream watches folders, so one single file is watched as its folder narrowed down to its name.
    """
    reader = spark.readStream.schema(schema or spark.read.format(fmt).load(path).schema)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if "*" not in path and store.exists(place) and store.getFileStatus(place).isFile():
        reader = reader.option("pathGlobFilter", place.getName())
        path = place.getParent().toString()
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(path)


def _finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def each_batch(
    df: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    """Run `work(batch, number)` on every micro-batch until what is there now is used up."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return _finish(writer.foreachBatch(work).trigger(availableNow=True).start())


def import_stream(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append each arriving file exactly once: the checkpoint and the file sink's log are the ledger."""
    return _finish(
        df.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_folder(target: str, number: int) -> str:
    return f"{target}/batch={number}"


class _Files:
    """Small text files beside a target; each appears whole or not at all, and none is replaced."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.folder = spark._jvm, folder
        conf = spark._jsc.hadoopConfiguration()
        self.store = self.path("").getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.store.getUri(), conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.store.listStatus(self.path(""))) if self.store.exists(self.path("")) else []

    def read(self, name: str) -> str:
        stream = self.store.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write aside and rename; False if the name is taken."""
        aside = self.path(f"_aside-{uuid.uuid4().hex}")
        out = self.store.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        options = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            self.context.rename(aside, self.path(name), options)
            return True
        except Exception as error:
            self.store.delete(aside, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise


def claim(spark: SparkSession, target: str, checkpoint: str) -> None:
    """Bind a target to the checkpoint that fills it: batch numbers of another would replace its folders."""
    files = _Files(spark, target)
    if files.create("_checkpoint", checkpoint):
        return
    owner = files.read("_checkpoint")
    if owner != checkpoint:
        raise ValueError(f"{target} is filled from checkpoint {owner}; take another target")


Reduce = Callable[[DataFrame], DataFrame]


class Folded:
    """The batches of a target, folded by `reduce`, which takes rows with their `batch` and gives rows of the same columns.

    `reduce` must not mind how its input was cut: reducing reduced rows with further ones is reducing them all.
    """

    def __init__(self, spark: SparkSession, target: str, schema: T.StructType, reduce: Reduce, every: int = FOLD_EVERY):
        self.spark, self.target, self.reduce, self.every = spark, target, reduce, every
        self.schema = T.StructType([*schema, T.StructField("batch", T.IntegerType())])
        self.records = _Files(spark, f"{target}/_folds")
        self.files = _Files(spark, target)

    def last(self) -> tuple[int, str | None]:
        """(last batch folded, base folder)."""
        done = [name for name in self.records.names() if name.endswith(".json")]
        record = json.loads(self.records.read(done[-1])) if done else {"upto": -1, "base": None}
        return record["upto"], record["base"]

    def waiting(self, upto: int) -> list[int]:
        numbers = [int(name[6:]) for name in self.files.names() if name.startswith("batch=")]
        return sorted(n for n in numbers if n > upto)

    def _rows(self, base: str | None, batches: Sequence[int]) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        parts = [reader.parquet(base)] if base else []
        if batches:
            parts.append(reader.option("basePath", self.target).parquet(*[batch_folder(self.target, n) for n in batches]))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def fold(self, before: int) -> None:
        """Fold the waiting batches with numbers below `before`, whose work is known to be done, if there are enough."""
        upto, base = self.last()
        batches = [n for n in self.waiting(upto) if n < before]
        if len(batches) < self.every:
            return
        folder = f"{self.target}/_base/{batches[-1]:010d}-{uuid.uuid4().hex}"
        self.reduce(self._rows(base, batches)).write.parquet(folder)
        self.records.create(f"{batches[-1]:010d}.json", json.dumps({"upto": batches[-1], "base": folder}))

    def read(self) -> DataFrame:
        """All batches reduced: from the base and what waits."""
        upto, base = self.last()
        return self.reduce(self._rows(base, self.waiting(upto)))

    def write(self, batch: DataFrame, number: int) -> None:
        """Write a batch to its folder. Spark starts a batch when those before it are done for good, so these may be folded."""
        batch.write.mode("overwrite").parquet(batch_folder(self.target, number))
        self.fold(number)

    def expire(self) -> None:
        """Delete batches and bases that the last fold has made superfluous; nobody may be reading them any more."""
        upto, base = self.last()
        for name in self.files.names():
            if name.startswith("batch=") and int(name[6:]) <= upto:
                self.files.store.delete(self.files.path(name), True)
        bases = _Files(self.spark, f"{self.target}/_base")
        for name in bases.names():
            if base and not base.endswith(f"/{name}"):
                bases.store.delete(bases.path(name), True)


def windowed_stats(
    df: DataFrame, ts: str, key: str, value: str, target: str, checkpoint: str, width: str = "1 hour", late: str = "1 hour"
) -> DataFrame:
    """Count, sum, mean, minimum and maximum per key and window, rows later than `late` dropped.

    Emits updated windows per batch; the returned table keeps the newest state of each window. With nothing late it equals
    the batch aggregation.
    """
    stats = (
        df.withWatermark(ts, late)
        .groupBy(F.window(ts, width).alias("window"), F.col(key))
        .agg(
            F.count(value).alias("n"),
            F.sum(value).alias("total"),
            F.avg(value).alias("mean"),
            F.min(value).alias("lowest"),
            F.max(value).alias("highest"),
        )
        .select(F.col("window.start").alias("start"), key, *STATS)
    )
    def newest(rows: DataFrame) -> DataFrame:
        last = rows.groupBy("start", key).agg(F.max(F.struct("batch", *STATS)).alias("last"))
        return last.select("start", key, *[f"last.{c}" for c in STATS], "last.batch")

    claim(df.sparkSession, target, checkpoint)
    folded = Folded(df.sparkSession, target, stats.schema, newest)
    each_batch(stats, checkpoint, folded.write, "update")
    return folded.read().drop("batch")


def first_per_key(df: DataFrame, keys: Sequence[str], ts: str, target: str, checkpoint: str, late: str) -> DataFrame:
    """Keep the first row of each key within the watermark. Unlike the batch dedupe it cannot wait for the highest value."""
    kept = df.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))
    claim(df.sparkSession, target, checkpoint)
    # no two batches share a key within the watermark, so folding only gathers their rows
    folded = Folded(df.sparkSession, target, kept.schema, lambda rows: rows)
    each_batch(kept, checkpoint, folded.write)
    return folded.read().drop("batch")


def best_per_key(df: DataFrame, keys: Sequence[str], best: str, target: str, checkpoint: str) -> DataFrame:
    """Keep the highest `best` of each key: every batch is reduced on arrival, and batches when folded or read."""
    claim(df.sparkSession, target, checkpoint)
    folded = Folded(df.sparkSession, target, df.schema, lambda rows: keep_best(rows, keys, best))
    each_batch(df, checkpoint, lambda batch, number: folded.write(keep_best(batch, keys, best), number))
    return folded.read().drop("batch")


def merge_stream(
    changes: DataFrame, base: DataFrame, keys: Sequence[str], order: Sequence[str], target: str, checkpoint: str
) -> DataFrame:
    """Keep a keyed table current from a feed of changes.

    Each batch is reduced to its last change per key; folded batches hold the last change per key of all of them. The table is the
    base with these changes applied. A repeated batch rewrites its own folder and so changes nothing.
    """
    claim(changes.sparkSession, target, checkpoint)
    folded = Folded(changes.sparkSession, target, changes.schema, lambda rows: latest_changes(rows, keys, order))
    each_batch(changes, checkpoint, lambda batch, number: folded.write(latest_changes(batch, keys, order), number))
    return apply_changes(base, folded.read().drop("batch"), keys, order)


def audit_stream(
    df: DataFrame, checks: Sequence[Check], good: str, bad: str, results: str, checkpoint: str
) -> StreamingQuery:
    """Check every batch in one pass, set rows aside that break a row check, and keep the outcomes."""
    row_checks = [check for check in checks if check.keep is not None]

    def audit(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            run_suite(held, checks).write.mode("overwrite").parquet(batch_folder(results, number))
            broken = F.lit(False)
            for check in row_checks:
                broken = broken | ~check.keep()
            held.filter(~broken).write.mode("overwrite").parquet(batch_folder(good, number))
            held.filter(broken).write.mode("overwrite").parquet(batch_folder(bad, number))
        finally:
            held.unpersist()

    for target in (good, bad, results):
        claim(df.sparkSession, target, checkpoint)
    return each_batch(df, checkpoint, audit)


def read_batches(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """All batches with their number; with a `schema`, no rows where there is no batch yet."""
    reader = spark.read.option("basePath", target)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema, T.StructField("batch", T.IntegerType())]))
    return reader.parquet(target)


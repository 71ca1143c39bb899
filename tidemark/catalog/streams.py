"""Streaming variants, run to the end of what is there; each must agree with the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.lakes import CHANGED_SQL, change_feed, short_orders
from tidemark.catalog.registry import Tables, query
from tidemark.operators import quality as q
from tidemark.streaming import jobs


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def stream_import(t: Tables) -> DataFrame:
    """Files arrive in two rounds; the second run picks up only the new ones."""
    arriving, target, checkpoint = t.scratch("arriving"), t.scratch("imported"), t.scratch("checkpoint")
    for number, rows in enumerate(("o_orderstatus IS DISTINCT FROM 'P'", "o_orderstatus = 'P'", None)):
        if rows:
            short_orders(t).filter(rows).write.parquet(f"{arriving}/{number}")
        stream = jobs.file_stream(
            t.spark, f"{arriving}/*", "o_orderkey bigint, o_orderstatus string, o_totalprice double", files_per_batch=4
        )
        jobs.import_stream(stream, target, checkpoint)
    return t.spark.read.parquet(target)


@query(
    """SELECT DATE_TRUNC('hour', ts) AS hour, event_type, COUNT(value) AS n, ROUND(SUM(value), 2) / COUNT(value) AS mean,
         MIN(value) AS lowest, MAX(value) AS highest FROM events GROUP BY ALL"""
)
def stream_hourly_stats(t: Tables) -> DataFrame:
    events = jobs.file_stream(t.spark, t.path("events")).withColumn("ts", F.col("ts").cast("timestamp"))
    stats = jobs.windowed_stats(
        events, "ts", "event_type", "value", t.scratch("stats"), t.scratch("checkpoint"), "1 hour", "2 hours"
    )
    mean = (F.round("total", 2) / F.col("n")).alias("mean")
    return stats.select(F.col("start").cast("timestamp_ntz").alias("hour"), "event_type", "n", mean, "lowest", "highest")


@query("SELECT DISTINCT event_type, DATE_TRUNC('hour', ts) AS hour FROM events")
def stream_first_per_key(t: Tables) -> DataFrame:
    events = jobs.file_stream(t.spark, t.path("events")).select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.date_trunc("hour", "ts").alias("hour"),
        "event_type",
        "value",
    )
    kept = jobs.first_per_key(
        events, ["event_type", "hour"], "ts", t.scratch("first"), t.scratch("checkpoint"), "2 hours"
    )
    return kept.select("event_type", F.col("hour").cast("timestamp_ntz").alias("hour"))


@query(
    """SELECT event_type, DATE_TRUNC('hour', ts) AS hour, MAX(value) AS value FROM events GROUP BY ALL"""
)
def stream_best_per_key(t: Tables) -> DataFrame:
    readings = jobs.file_stream(t.spark, t.path("events")).select(
        "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "value"
    )
    return jobs.best_per_key(readings, ["event_type", "hour"], "value", t.scratch("best"), t.scratch("checkpoint"))


@query(CHANGED_SQL)
def stream_change_merge(t: Tables) -> DataFrame:
    arriving = t.scratch("changes")
    change_feed(t).write.parquet(arriving)
    changes = jobs.file_stream(t.spark, arriving, files_per_batch=4)
    return jobs.merge_stream(
        changes, short_orders(t), ["o_orderkey"], ["seq"], t.scratch("log"), t.scratch("checkpoint")
    )


@query(
    """SELECT 'good' AS kind, COUNT(*) AS n FROM events WHERE event_type IN ('view', 'click', 'purchase') AND value > 0
       UNION ALL SELECT 'bad', COUNT(*) FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') OR value <= 0"""
)
def stream_audit(t: Tables) -> DataFrame:
    good, bad, results = t.scratch("good"), t.scratch("bad"), t.scratch("results")
    checks = [q.accepted_values("event_type", ["view", "click", "purchase"]), q.positive("value")]
    jobs.audit_stream(jobs.file_stream(t.spark, t.path("events")), checks, good, bad, results, t.scratch("checkpoint"))
    return jobs.read_batches(t.spark, good).agg(F.lit("good").alias("kind"), F.count(F.lit(1)).alias("n")).unionByName(
        jobs.read_batches(t.spark, bad).agg(F.lit("bad").alias("kind"), F.count(F.lit(1)).alias("n"))
    )

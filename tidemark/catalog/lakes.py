"""Files, imports, materialisation and versions, on files and tables derived from the given ones."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import Tables, query
from tidemark.functions.text import named_groups
from tidemark.operators import diffs
from tidemark.operators import quality as q
from tidemark.plans.versions import Lake, diff_versions, filter_history, replay
from tidemark.sinks.export import preview, read_json_array, scratch_export
from tidemark.sources import importer, schema_plan
from tidemark.sources.files import list_files, read_files, read_prefix

# -- formats -----------------------------------------------------------------------------------------------------------

_ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"


def short_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(_ORDERS)
def export_parquet(t: Tables) -> DataFrame:
    return read_files(t.spark, scratch_export(short_orders(t), "parquet"))


@query(_ORDERS)
def export_csv_with_header(t: Tables) -> DataFrame:
    path = scratch_export(short_orders(t), "csv")
    return read_files(t.spark, path, "csv", "o_orderkey bigint, o_orderstatus string, o_totalprice double")


@query("SELECT event_id, event_type, value, props FROM events")
def export_json_lines(t: Tables) -> DataFrame:
    path = scratch_export(t.events.select("event_id", "event_type", "value", "props"), "jsonl")
    return read_files(t.spark, path, "jsonl", "event_id bigint, event_type string, value double, props string")


@query(f"{_ORDERS} ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def export_json_array(t: Tables) -> DataFrame:
    top = short_orders(t).orderBy(F.desc("o_totalprice"), "o_orderkey")
    path = scratch_export(top, "json", limit=50)
    return read_json_array(t.spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'F')")
def read_by_globs(t: Tables) -> DataFrame:
    root = t.scratch("by-status")
    short_orders(t).write.partitionBy("o_orderstatus").parquet(root)
    patterns = [f"{root}/o_orderstatus=O/*.parquet", f"{root}/*=F/*.parquet"]
    return read_files(t.spark, patterns).select("o_orderkey", "o_totalprice")


def event_days(t: Tables) -> str:
    """Events in hive-style folders of year, month and day; rows of a day are gathered first."""
    root = t.scratch("event-days")
    ts = F.col("ts")
    dated = t.events.select("*", F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"))
    dated.hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").parquet(root)
    return root


@query(
    """SELECT event_id, value, 2024::INTEGER AS year, 1::INTEGER AS month, 9::INTEGER AS day FROM events
       WHERE CAST(ts AS DATE) = DATE '2024-01-09'"""
)
def read_day_by_prefix(t: Tables) -> DataFrame:
    day = read_prefix(t.spark, event_days(t), "year=2024/month=1/day=9")
    return day.select("event_id", "value", "year", "month", "day")


# -- planning and import -----------------------------------------------------------------------------------------------


def mixed_files(t: Tables) -> str:
    """Lineitem written by two producers: one stores part keys as int, and ship times as text."""
    root = t.scratch("mixed")
    columns = ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"]
    shipped = F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("shipped")
    lines = t.lineitem.select(*columns, shipped)
    lines.filter("l_returnflag = 'A'").withColumn("l_partkey", F.col("l_partkey").cast("int")).write.parquet(f"{root}/a")
    lines.filter("l_returnflag IS DISTINCT FROM 'A'").write.parquet(f"{root}/b")
    return f"{root}/*/*.parquet"


@query(
    """SELECT * FROM (VALUES ('l_orderkey', ['bigint'], false), ('l_partkey', ['bigint', 'int'], true),
       ('l_quantity', ['double'], false), ('l_returnflag', ['string'], false), ('shipped', ['string'], false))
       AS v("column", types, conflict)"""
)
def plan_finds_conflict(t: Tables) -> DataFrame:
    footer = schema_plan.footers(list_files(t.spark, mixed_files(t)))
    return schema_plan.column_types(footer).select("column", "types", "conflict")


@query(
    """SELECT l_returnflag, COUNT(*) AS n, CAST(SUM(l_partkey) AS BIGINT) AS part_sum, MIN(l_shipdate) AS first_shipped,
       MAX(l_shipdate) AS last_shipped FROM lineitem GROUP BY l_returnflag"""
)
def read_resolved_conflict(t: Tables) -> DataFrame:
    files = mixed_files(t)
    plan = schema_plan.plan_table(t.spark, files).resolve(
        {
            "l_partkey": "long",
            "shipped": {"datatype": "timestamp", "unit": "us", "parse_format": "%Y%m%d%H%M%S"},
        }
    )
    rows = schema_plan.read_files_as(t.spark, files, plan)
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_partkey").alias("part_sum"),
        F.min("shipped").alias("first_shipped"),
        F.max("shipped").alias("last_shipped"),
    )


@query("SELECT l_orderkey, l_partkey, l_quantity, l_returnflag, '' AS shipped FROM lineitem WHERE false")
def planned_table_is_empty(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    plan = schema_plan.plan_table(t.spark, mixed_files(t), "l_returnflag").resolve({"l_partkey": "long"})
    importer.apply_plan(lake, "lines", plan)
    return lake.read("lines")


@query("SELECT true AS refused, ['l_partkey'] AS conflicts, COUNT(*) AS readable_rows FROM lineitem")
def create_refuses_conflict(t: Tables) -> DataFrame:
    files, lake = mixed_files(t), Lake(t.spark, t.scratch("lake"))
    try:
        importer.create_table(lake, "lines", files)
        refused = False
    except schema_plan.SchemaConflict:
        refused = True
    plan = schema_plan.plan_table(t.spark, files)
    decided = plan.resolve({"l_partkey": "long"})
    return schema_plan.read_files_as(t.spark, files, decided).agg(
        F.lit(refused).alias("refused"),
        F.array(*[F.lit(c) for c in plan.conflicts]).alias("conflicts"),
        F.count(F.lit(1)).alias("readable_rows"),
    )


def order_files(t: Tables) -> str:
    """Orders in one folder per status, whatever statuses there are."""
    root = t.scratch("order-files")
    short_orders(t).withColumn("status", F.col("o_orderstatus")).write.partitionBy("status").parquet(root)
    return root


@query(
    """SELECT o_orderstatus, 2 * COUNT(*) AS rows_imported, COUNT(DISTINCT o_orderkey) AS different FROM orders
       GROUP BY o_orderstatus"""
)
def import_once_then_forced(t: Tables) -> DataFrame:
    lake, root = Lake(t.spark, t.scratch("lake")), order_files(t)
    files = f"{root}/*/*.parquet"
    importer.create_table(lake, "orders_raw", files)
    importer.import_files(lake, "orders_raw", files)
    importer.import_files(lake, "orders_raw", files, allow_duplicates=True)
    importer.import_files(lake, "orders_raw", files)
    return lake.read("orders_raw").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows_imported"), F.count_distinct("o_orderkey").alias("different")
    )


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P' UNION ALL
       SELECT o_orderkey, o_orderstatus, NULL FROM orders WHERE o_orderstatus = 'P'"""
)
def import_best_effort(t: Tables) -> DataFrame:
    lake, root = Lake(t.spark, t.scratch("lake")), t.scratch("uneven")
    full = short_orders(t).filter("o_orderstatus <> 'P'")
    full.write.parquet(f"{root}/full")
    other = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    other.write.parquet(f"{root}/other")
    importer.create_table(lake, "orders_raw", f"{root}/full/*.parquet")
    importer.import_files(lake, "orders_raw", f"{root}/*/*.parquet", best_effort=True)
    return lake.read("orders_raw")


@query(
    """SELECT o_orderstatus, COUNT(*) AS n, 1::BIGINT AS failed_files FROM orders GROUP BY o_orderstatus"""
)
def import_past_bad_file(t: Tables) -> DataFrame:
    lake, root = Lake(t.spark, t.scratch("lake")), order_files(t)
    importer.create_table(lake, "orders_raw", f"{root}/*/*.parquet")
    broken = lake._fs.create(lake._path(f"{root}/status=O/broken.parquet"))
    broken.write(bytearray(b"not a parquet file"))
    broken.close()
    status = importer.import_files(lake, "orders_raw", f"{root}/*/*.parquet", continue_on_error=True)
    failed = status.filter("status = 'failed'").count()
    return lake.read("orders_raw").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.lit(failed).cast("long").alias("failed_files")
    )


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def import_csv_once(t: Tables) -> DataFrame:
    """Types found in the text of all rows; the second import finds nothing new."""
    lake, files = Lake(t.spark, t.scratch("lake")), t.scratch("csv")
    short_orders(t).write.option("header", True).csv(files)
    importer.create_table(lake, "orders_raw", files, fmt="csv")
    for _ in range(2):
        importer.import_files(lake, "orders_raw", files, fmt="csv")
    return lake.read("orders_raw").withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def import_jsonl_once(t: Tables) -> DataFrame:
    lake, files = Lake(t.spark, t.scratch("lake")), t.scratch("jsonl")
    short_orders(t).write.json(files)
    importer.create_table(lake, "orders_raw", files, fmt="jsonl")
    for _ in range(2):
        importer.import_files(lake, "orders_raw", files, fmt="jsonl")
    return lake.read("orders_raw")


@query("SELECT 'l_partkey' AS conflict, COUNT(*) AS readable_rows, SUM(l_quantity) AS quantity FROM lineitem")
def csv_conflict_resolved(t: Tables) -> DataFrame:
    """One producer writes part keys as numbers, the other as text: a conflict found in the values, and read as text."""
    root = t.scratch("csv")
    lines = t.lineitem.select("l_orderkey", "l_quantity", F.col("l_partkey").cast("string").alias("l_partkey"), "l_returnflag")
    text = F.concat(F.lit("P"), "l_partkey").alias("l_partkey")
    lines.filter("l_returnflag = 'A'").drop("l_returnflag").write.option("header", True).csv(f"{root}/a")
    other = lines.filter("l_returnflag IS DISTINCT FROM 'A'").select(text, "l_quantity", "l_orderkey")
    other.write.option("header", True).csv(f"{root}/b")
    plan = schema_plan.plan_table(t.spark, f"{root}/*", fmt="csv")
    rows = schema_plan.read_files_as(t.spark, f"{root}/*", plan.resolve({"l_partkey": "string", "l_quantity": "double"}), fmt="csv")
    return rows.agg(
        F.lit(",".join(plan.conflicts)).alias("conflict"), F.count(F.lit(1)).alias("readable_rows"), F.sum("l_quantity").alias("quantity")
    )


@query("SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus")
def external_table(t: Tables) -> DataFrame:
    lake, root = Lake(t.spark, t.scratch("lake")), order_files(t)
    lake.register_external("orders_ext", [f"{root}/status=[!P_]*/*.parquet"])
    return lake.read("orders_ext").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM events
       WHERE CAST(ts AS DATE) IN (DATE '2024-01-03', DATE '2024-01-04') GROUP BY event_type"""
)
def ingest_days_with_audit(t: Tables) -> DataFrame:
    """Two daily partitions, each imported, audited and published on its own; running a day again adds nothing.

    Values are amounts rounded to cents, so a value of 0 is a good row that the SQL counts; below 0 or null is not.
    """
    lake, root = Lake(t.spark, t.scratch("lake")), event_days(t)
    checks = [q.all_unique("event_id"), q.no_nulls("user_id"), q.satisfies("not_negative", "value", "value >= 0")]
    importer.create_table(lake, "events_raw", f"{root}/year=2024/month=1/day=3/*.parquet")
    for day in (3, 4, 3):
        importer.import_files(lake, "events_raw", f"{root}/year=2024/month=1/day={day}/*.parquet", checks=checks)
    return lake.read("events_raw").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


# -- materialisation ---------------------------------------------------------------------------------------------------


@query("SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus")
def replace_twice(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    for _ in range(2):
        lake.publish({"orders": short_orders(t)}, strategy="REPLACE")
    return lake.read("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderstatus, 2 * COUNT(*) AS n FROM orders GROUP BY o_orderstatus")
def append_twice(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    for _ in range(2):
        lake.publish({"orders": short_orders(t)}, strategy="APPEND")
    return lake.read("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH daily AS (SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n, 1::INTEGER AS run FROM events GROUP BY ALL)
       SELECT day, event_type, n, run FROM daily WHERE NOT (day >= DATE '2024-01-10' AND day < DATE '2024-01-12') UNION ALL
       SELECT day, event_type, n, 2::INTEGER FROM daily WHERE day >= DATE '2024-01-10' AND day < DATE '2024-01-12'
         AND event_type <> 'error'"""
)
def overwrite_partitions(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    daily = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    lake.publish({"daily": daily.withColumn("run", F.lit(1))}, partitioned_by=["day"])
    again = daily.filter("day >= '2024-01-10' AND day < '2024-01-12' AND event_type <> 'error'")
    lake.publish(
        {"daily": again.withColumn("run", F.lit(2))},
        strategy="OVERWRITE_PARTITIONS",
        overwrite_filter="day >= '2024-01-10' AND day < '2024-01-12'",
    )
    return lake.read("daily")


@query(
    """SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-07 12:00:00'
       AND ts < TIMESTAMP '2024-01-09 06:30:00' AND user_id = 7"""
)
def partition_transforms_prune(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    rows = t.events.select("event_id", "user_id", "ts")
    lake.publish({"events": rows}, partitioned_by="DAY(ts), bucket(4, user_id)")
    where = [("ts", ">=", "2024-01-07 12:00:00"), ("ts", "<", "2024-01-09 06:30:00"), ("user_id", "=", 7)]
    return lake.read("events", where=where)


@query("SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-08' AND user_id IS NOT NULL")
def scan_prunes_day(t: Tables) -> DataFrame:
    """SQL over a table with one folder per day; the filter on its own column decides which folder is read."""
    lake = Lake(t.spark, t.scratch("lake"))
    lake.publish({"events": t.events.select("event_id", "user_id", "value", "ts")}, partitioned_by="day(ts)")
    return lake.query("SELECT event_id, user_id, value FROM events WHERE to_date(ts) = '2024-01-08' AND user_id IS NOT NULL")


@query(
    """SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n, CAST(DAY(ts) AS INTEGER) AS run FROM events
       GROUP BY ALL"""
)
def overwrite_thirty_days(t: Tables) -> DataFrame:
    """Every day of a month overwritten in turn; what is read is one scan of the last folders."""
    lake = Lake(t.spark, t.scratch("lake"))
    daily = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    lake.publish({"daily": daily.withColumn("run", F.lit(0))}, partitioned_by=["day"])
    days = [r.day for r in lake.read("daily").select("day").distinct().orderBy("day").collect()]
    for day in days:
        rows = lake.scan("daily", at=1, filters="day = $day", params={"day": day}).withColumn("run", F.dayofmonth("day"))
        lake.publish({"daily": rows}, strategy="OVERWRITE_PARTITIONS", overwrite_filter=f"day = '{day}'")
    return lake.read("daily")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_head(t: Tables) -> DataFrame:
    return preview(t.orders.select("o_orderkey", "o_totalprice"), "head", 10, ["o_orderkey"])


@query(
    "SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 10) ORDER BY o_orderkey"
)
def preview_tail(t: Tables) -> DataFrame:
    return preview(t.orders.select("o_orderkey", "o_totalprice"), "tail", 10, ["o_orderkey"])


# -- versions ----------------------------------------------------------------------------------------------------------


@query("SELECT o_orderstatus, COUNT(*) AS n, false AS bad_batch_published FROM orders GROUP BY o_orderstatus")
def write_audit_publish(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    checks = {"orders": [q.all_unique("o_orderkey"), q.positive("o_totalprice")]}
    lake.publish({"orders": short_orders(t)}, checks=checks)
    try:
        bad = short_orders(t).withColumn("o_totalprice", -F.col("o_totalprice"))
        lake.publish({"orders": bad}, checks=checks)
        published = True
    except q.ExpectationFailed:
        published = False
    return lake.read("orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.lit(published).alias("bad_batch_published")
    )


@query(
    """SELECT 'customers' AS "table", COUNT(*) AS n, 1::BIGINT AS version FROM customer UNION ALL
       SELECT 'orders', COUNT(*), 1 FROM orders"""
)
def publish_tables_together(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    version = lake.publish({"orders": short_orders(t), "customers": t.customer})
    counts = [
        lake.read(name, version).agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("n"), F.lit(version).cast("long").alias("version")
        )
        for name in ("orders", "customers")
    ]
    return counts[0].unionByName(counts[1])


@query(
    """SELECT 'first' AS version, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'O' UNION ALL
       SELECT 'tagged', COUNT(*) FROM orders WHERE o_orderstatus <> 'P' UNION ALL
       SELECT 'one back', COUNT(*) FROM orders WHERE o_orderstatus <> 'P' UNION ALL
       SELECT 'latest', COUNT(*) FROM orders"""
)
def read_as_of(t: Tables) -> DataFrame:
    lake, df = Lake(t.spark, t.scratch("lake")), short_orders(t)
    lake.publish({"orders": df.filter("o_orderstatus = 'O'")})
    lake.publish({"orders": df.filter("o_orderstatus <> 'P'")})
    lake.tag("checked")
    lake.publish({"orders": df})
    reads = {"first": 1, "tagged": "checked", "one back": "main^1", "latest": None}
    counted = [
        lake.read("orders", at).agg(F.lit(name).alias("version"), F.count(F.lit(1)).alias("n"))
        for name, at in reads.items()
    ]
    return counted[0].union(counted[1]).union(counted[2]).union(counted[3])


@query(
    """SELECT 'before the merge' AS moment, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'O' UNION ALL
       SELECT 'after the merge', COUNT(*) FROM orders UNION ALL
       SELECT 'line before its fork', COUNT(*) FROM orders WHERE o_orderstatus = 'O' UNION ALL
       SELECT 'line before the merge', COUNT(*) FROM orders"""
)
def read_line_at_time(t: Tables) -> DataFrame:
    """What a line held at a time: work on another line counts from its merge, and before its fork a line is what it came from."""
    lake, df = Lake(t.spark, t.scratch("lake")), short_orders(t)
    lake.publish({"orders": df.filter("o_orderstatus = 'O'")})
    first = lake.record()["ts"]
    fix = lake.fork("fix")
    fix.publish({"orders": df})
    fixed = fix.record()["ts"]
    lake.merge("fix")
    moments = {
        "before the merge": ("main", fixed), "after the merge": ("main", lake.record()["ts"]),
        "line before its fork": ("fix", first), "line before the merge": ("fix", fixed),
    }
    frames = [
        lake.read("orders", f"{line}*{dt.datetime.fromtimestamp(ts, dt.timezone.utc).isoformat()}").agg(
            F.lit(moment).alias("moment"), F.count(F.lit(1)).alias("n")
        )
        for moment, (line, ts) in moments.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query("SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 1000 GROUP BY ALL")
def sql_at_a_version(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    lake.publish({"sales.orders": short_orders(t).filter("o_orderstatus <> 'P'")})
    lake.publish({"sales.orders": short_orders(t).limit(1)})
    sql = "SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_totalprice > $least GROUP BY ALL"
    return lake.query(sql, at=1, namespace="sales", params={"least": 1000})


@query("""SELECT * FROM (VALUES ('suppliers', 'added'), ('customers', 'removed')) AS v("table", change)""")
def diff_table_sets(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    lake.publish({"customers": t.customer, "orders": short_orders(t)})
    lake.drop("customers")
    lake.publish({"suppliers": t.supplier})
    return diff_versions(lake, 1, 3)


def reworked_orders(t: Tables) -> DataFrame:
    """Orders after a day of work: urgent ones repriced, low-priority pending ones gone, the largest ordered again."""
    df = short_orders(t).join(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    kept = df.filter("NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')")
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice"))
    again = df.filter("o_totalprice > 450000").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return kept.withColumn("o_totalprice", price).unionByName(again).drop("o_orderpriority")


_REWORKED = """base AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
  reworked AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 10
    ELSE o_totalprice END AS o_totalprice FROM base WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
    UNION ALL SELECT -o_orderkey - 1, o_orderstatus, o_totalprice FROM base WHERE o_totalprice > 450000)"""


@query(
    f"""WITH {_REWORKED} SELECT COALESCE(b.o_orderkey, r.o_orderkey) AS o_orderkey,
         CASE WHEN b.o_orderkey IS NULL THEN 'added' WHEN r.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change
       FROM base b FULL JOIN reworked r ON b.o_orderkey = r.o_orderkey
       WHERE b.o_orderkey IS NULL OR r.o_orderkey IS NULL OR b.o_totalprice <> r.o_totalprice"""
)
def diff_rows_by_key(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    lake.publish({"orders": short_orders(t)})
    lake.publish({"orders": reworked_orders(t)})
    return diffs.diff_rows(lake.read("orders", 1), lake.read("orders", 2), ["o_orderkey"])


@query(
    """SELECT l_suppkey, l_quantity, CAST(SUM(d) AS BIGINT) AS delta FROM (SELECT l_suppkey, l_quantity, -1 AS d FROM lineitem
         UNION ALL SELECT l_suppkey, CASE WHEN l_linestatus = 'F' THEN l_quantity + 1 ELSE l_quantity END, 1 FROM lineitem
         WHERE l_returnflag <> 'R') GROUP BY ALL HAVING SUM(d) <> 0"""
)
def diff_rows_without_key(t: Tables) -> DataFrame:
    before = t.lineitem.select("l_suppkey", "l_quantity")
    quantity = F.when(F.col("l_linestatus") == "F", F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    after = t.lineitem.filter("l_returnflag <> 'R'").select("l_suppkey", quantity.alias("l_quantity"))
    return diffs.diff_bags(before, after)


@query(
    """SELECT * FROM (VALUES ('c_nationkey', 'retyped', 'int', 'bigint'), ('c_acctbal', 'removed', 'double', NULL),
       ('c_tier', 'added', NULL, 'string')) AS v("column", change, old_type, new_type)"""
)
def diff_schemas(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    lake.publish({"customers": t.customer})
    after = t.customer.withColumn("c_nationkey", F.col("c_nationkey").cast("long")).drop("c_acctbal")
    lake.publish({"customers": after.withColumn("c_tier", F.lit("gold"))})
    return diffs.diff_schema(lake.read("customers", 1), lake.read("customers", 2))


def ours_and_theirs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A base and two edits: urgent orders repriced by both, alike where finished and differently where open."""
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    price, urgent = F.col("o_totalprice"), F.col("o_orderpriority") == "1-URGENT"
    ours = base.filter("NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')").withColumn(
        "o_totalprice", F.when(urgent, price + 10).otherwise(price)
    )
    finished = F.col("o_orderstatus") == "F"
    high = F.col("o_orderpriority") == "2-HIGH"
    theirs = base.withColumn(
        "o_totalprice",
        F.when(urgent & finished, price + 10).when(urgent, price + 20).when(high, price + 5).otherwise(price),
    ).filter("NOT (o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM')")
    return base, ours, theirs


@query(
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 10
         WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 5 ELSE o_totalprice END AS o_totalprice, o_orderpriority
       FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
         AND NOT (o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM')
         AND NOT (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F')"""
)
def merge_three_way(t: Tables) -> DataFrame:
    merged, _ = diffs.merge_rows(*ours_and_theirs(t), ["o_orderkey"])
    return merged


@query(
    """SELECT o_orderkey, 'changed' AS ours_change, 'changed' AS theirs_change FROM orders
       WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F'"""
)
def merge_conflicts(t: Tables) -> DataFrame:
    _, conflicts = diffs.merge_rows(*ours_and_theirs(t), ["o_orderkey"])
    return conflicts


@query(
    """SELECT true AS second_merge_refused, COUNT(*) AS n, (SELECT COUNT(*) FROM customer) AS customers FROM orders
       WHERE o_orderstatus = 'O'"""
)
def merge_lines(t: Tables) -> DataFrame:
    """Two lines create the same table: the first merge passes, the second is refused; other tables merge freely."""
    from tidemark.plans.versions import VersionConflict

    lake = Lake(t.spark, t.scratch("lake"))
    lake.publish({"suppliers": t.supplier})
    a, b, c = lake.fork("a"), lake.fork("b"), lake.fork("c")
    a.publish({"orders": short_orders(t).filter("o_orderstatus = 'O'")})
    b.publish({"orders": short_orders(t)})
    c.publish({"customers": t.customer})
    lake.merge("a")
    lake.merge("c")
    try:
        lake.merge("b")
        refused = False
    except VersionConflict:
        refused = True
    customers = lake.read("customers").count()
    return lake.read("orders").agg(
        F.lit(refused).alias("second_merge_refused"),
        F.count(F.lit(1)).alias("n"),
        F.lit(customers).cast("long").alias("customers"),
    )


@query(_ORDERS)
def revert_table(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    lake.publish({"orders": short_orders(t)})
    lake.publish({"orders": short_orders(t).withColumn("o_totalprice", F.lit(0.0))})
    lake.revert("orders", 1, replace=True)
    return lake.read("orders")


@query(
    """SELECT p_partkey, 0::INTEGER AS year, p_retailprice AS price FROM part UNION ALL
       SELECT p_partkey, 1, ROUND(p_retailprice * POW(1.03, 1), 6) FROM part UNION ALL
       SELECT p_partkey, 2, ROUND(p_retailprice * POW(1.03, 2), 6) FROM part"""
)
def repair_by_replay(t: Tables) -> DataFrame:
    """Two bad appends are reverted on a side line, replayed with the right formula and merged once."""
    lake = Lake(t.spark, t.scratch("lake"))

    def grown(year: int, base: float) -> DataFrame:
        price = F.col("p_retailprice") * F.pow(F.lit(base), F.lit(year))
        return t.part.select("p_partkey", F.lit(year).alias("year"), F.round(price, 6).alias("price"))

    lake.publish({"prices": t.part.select("p_partkey", F.lit(0).alias("year"), F.col("p_retailprice").alias("price"))})
    lake.tag("healthy")
    for year in (1, 2):
        lake.publish({"prices": grown(year, 0.03)}, strategy="APPEND")
    fix = lake.fork("fix")
    fix.revert("prices", "healthy", replace=True)
    replay(fix, "prices", [grown(year, 1.03) for year in (1, 2)])
    lake.merge("fix")
    return lake.read("prices")


@query(
    """SELECT 'load ' || event_type AS subject, 'rows: ' || COUNT(*) AS body, 'nightly' AS author FROM events
       WHERE event_type IN ('click', 'view') GROUP BY event_type"""
)
def history_filtered(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    counted = {row["event_type"]: row["count"] for row in t.events.groupBy("event_type").count().collect()}
    for event_type, n in sorted(counted.items()):
        rows = t.events.filter(F.col("event_type") == event_type)
        note = {"kind": "page" if event_type in ("click", "view") else "account"}
        lake.publish(
            {"events": rows},
            strategy="APPEND",
            message=f"load {event_type}\n\nrows: {n}",
            author="nightly",
            properties=note,
        )
    found = filter_history(lake.history(), message="^load ", author="nightly", properties={"kind": "page"})
    return found.select("subject", "body", "author")


@query(
    """SELECT event_type AS task, COUNT(*) AS dead FROM events
       WHERE value > 20 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' GROUP BY event_type"""
)
def dead_branches_by_command(t: Tables) -> DataFrame:
    """Lines named `attempt <job>: <task> for <user>` whose job failed in a date window, counted by task."""
    name = F.concat(
        F.lit("attempt "), F.col("event_id").cast("string"), F.lit(": "), "event_type", F.lit(" for "), F.col("user_id").cast("string")
    )
    lines = t.events.select(*named_groups(name, r"attempt (\d+): (\S+) for (\d+)", ["job", "task", "owner"]))
    failed = t.events.filter("value > 20 AND ts >= '2024-01-05' AND ts < '2024-01-20'").select(
        F.col("event_id").cast("string").alias("job")
    )
    dead = lines.filter(F.col("job").isNotNull()).join(failed, "job", "left_semi")
    return dead.groupBy("task").agg(F.count(F.lit(1)).alias("dead"))


@query(
    """SELECT c_custkey, c_name AS name, c_mktsegment, NULL::VARCHAR AS tier FROM customer WHERE c_acctbal <= 5000 UNION ALL
       SELECT c_custkey, c_name, c_mktsegment, 'gold' FROM customer WHERE c_acctbal > 5000"""
)
def evolve_schema(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    lake.publish({"customers": t.customer.filter("c_acctbal <= 5000")})
    lake.evolve("customers", add={"tier": "string"}, rename={"c_name": "name"}, drop=["c_acctbal", "c_nationkey"])
    rich = t.customer.filter("c_acctbal > 5000").select(
        "c_custkey", F.col("c_name").alias("name"), "c_mktsegment", F.lit("gold").alias("tier")
    )
    lake.publish({"customers": rich}, strategy="APPEND")
    return lake.read("customers")


def change_feed(t: Tables) -> DataFrame:
    """Changes to orders: an update of every urgent order, then a delete of those still pending, and new large orders."""
    base = short_orders(t).join(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    urgent = base.filter("o_orderpriority = '1-URGENT'")
    updates = urgent.withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumns({"op": F.lit("update"), "seq": F.lit(1)})
    deletes = urgent.filter("o_orderstatus = 'P'").withColumns({"op": F.lit("delete"), "seq": F.lit(2)})
    inserts = base.filter("o_totalprice > 450000").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    inserts = inserts.withColumns({"op": F.lit("insert"), "seq": F.lit(3)})
    return updates.unionByName(deletes).unionByName(inserts).drop("o_orderpriority")


CHANGED_SQL = """SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P' UNION ALL
  SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT' UNION ALL
  SELECT -o_orderkey - 1, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 450000"""


@query(CHANGED_SQL)
def apply_change_feed(t: Tables) -> DataFrame:
    return diffs.apply_changes(short_orders(t), change_feed(t), ["o_orderkey"], ["seq"])

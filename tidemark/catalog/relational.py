"""Projections, predicates, joins, aggregations, ordering and scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import Tables, query
from tidemark.functions.numbers import exact_mean, exact_sum
from tidemark.functions.text import before_marker, named_groups
from tidemark.functions.times import spark_pattern, whole_minutes
from tidemark.operators.diffs import diff_names
from tidemark.operators.joins import full_by_key
from tidemark.operators.ranks import exact_median, number_ordered, number_rows, ordered_lists
from tidemark.operators.reports import histogram, keep_best
from tidemark.operators.reports import seeded_sample as sample
from tidemark.sources.scan import query as sql_query
from tidemark.sources.scan import scan


def net() -> Column:
    """Net revenue of a line: price less discount."""
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


# -- scans and SQL -----------------------------------------------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'"""
)
def scan_columns_filter(t: Tables) -> DataFrame:
    return scan(
        t.spark,
        t.path("lineitem"),
        columns=["l_orderkey", "l_partkey", "l_quantity"],
        filters="l_shipdate >= '1998-01-01' AND l_returnflag = 'R'",
    )


@query("SELECT LEAST(COUNT(*), 100) AS n FROM lineitem WHERE l_quantity > 10")
def scan_limit(t: Tables) -> DataFrame:
    limited = scan(t.spark, t.path("lineitem"), columns=["l_orderkey"], filters="l_quantity > 10", limit=100)
    return limited.agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = 7 AND o_orderdate >= TIMESTAMP '1996-01-01'")
def scan_with_parameters(t: Tables) -> DataFrame:
    return scan(
        t.spark,
        t.path("orders"),
        columns=["o_orderkey", "o_custkey"],
        filters="o_custkey = $customer AND o_orderdate >= $start",
        params={"customer": 7, "start": "1996-01-01"},
    )


@query(
    """SELECT c_mktsegment, COUNT(*) AS n, ROUND(SUM(c_acctbal), 2) / COUNT(c_acctbal) AS avg_balance FROM customer
       JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2 GROUP BY c_mktsegment"""
)
def sql_over_tables(t: Tables) -> DataFrame:
    return sql_query(
        t.spark,
        """SELECT c_mktsegment, COUNT(*) AS n, ROUND(SUM(c_acctbal), 2) / COUNT(c_acctbal) AS avg_balance
           FROM customer JOIN nation ON c_nationkey = n_nationkey
           WHERE n_regionkey = $region GROUP BY c_mktsegment""",
        tables={"customer": t.path("customer"), "nation": t.path("nation")},
        params={"region": 2},
    )


@query("SELECT LEAST(COUNT(*), 10) AS n FROM orders")
def sql_row_cap(t: Tables) -> DataFrame:
    capped = sql_query(t.spark, "SELECT o_orderkey FROM orders", tables={"orders": t.path("orders")}, max_rows=10)
    return capped.agg(F.count(F.lit(1)).alias("n"))


# -- projections and predicates ----------------------------------------------------------------------------------------


@query("SELECT o_custkey AS buyer, o_totalprice AS amount, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def select_alias_twice(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("buyer"), F.col("o_totalprice").alias("amount"), "o_custkey"
    )


@query("SELECT c_custkey AS customer_id, c_name, c_mktsegment, c_acctbal * 2 AS doubled FROM customer")
def rename_drop_append(t: Tables) -> DataFrame:
    return (
        t.customer.withColumnRenamed("c_custkey", "customer_id")
        .withColumn("doubled", F.col("c_acctbal") * 2)
        .drop("c_nationkey", "c_acctbal")
    )


@query(
    """SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' AND o_totalprice > 400000)
       OR (o_orderpriority <> '5-LOW' AND o_totalprice <= 5000)"""
)
def filter_and_or(t: Tables) -> DataFrame:
    rich = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)
    small = (F.col("o_orderpriority") != "5-LOW") & (F.col("o_totalprice") <= 5000)
    return t.orders.filter(rich | small).select("o_orderkey")


@query("SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def filter_between(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_size").between(10, 20)).select("p_partkey", "p_size")


@query(
    """SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')
       AND user_id NOT IN (1, 2, 3)"""
)
def filter_in_not_in(t: Tables) -> DataFrame:
    return t.events.filter(
        F.col("event_type").isin("click", "view") & ~F.col("user_id").isin(1, 2, 3)
    ).select("event_id", "event_type")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT LIKE '%-%E%'")
def filter_not_like(t: Tables) -> DataFrame:
    return t.orders.filter(~F.col("o_orderpriority").like("%-%E%")).select("o_orderkey", "o_orderpriority")


@query(
    """SELECT COUNT(*) FILTER (WHERE quality IS NULL) AS unlabelled, COUNT(*) FILTER (WHERE quality IS NOT NULL) AS labelled
       FROM documents LEFT JOIN labels USING (doc_id)"""
)
def null_tests(t: Tables) -> DataFrame:
    labelled = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return labelled.agg(
        F.count_if(F.col("quality").isNull()).alias("unlabelled"),
        F.count_if(F.col("quality").isNotNull()).alias("labelled"),
    )


@query(
    """SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 05:00:00' AND ts < TIMESTAMP '2024-01-11 05:00:00'"""
)
def iso_offset_range(t: Tables) -> DataFrame:
    # instants given with an offset compare in UTC, the session's zone
    zoned = t.events.withColumn("at", F.col("ts").cast("timestamp"))
    return zoned.filter("at >= '2024-01-10T00:00:00-05:00' AND at < '2024-01-11T00:00:00-05:00'").select(
        "event_id", "ts"
    )


@query(
    """WITH large AS (SELECT o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000)
       SELECT 'large orders' AS what, MAX(o_custkey) AS last_buyer, COUNT(*) AS n FROM large"""
)
def cte_max_literal(t: Tables) -> DataFrame:
    return sql_query(
        t.spark,
        """WITH large AS (SELECT o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000)
           SELECT 'large orders' AS what, MAX(o_custkey) AS last_buyer, COUNT(*) AS n FROM large""",
        tables={"orders": t.path("orders")},
    )


@query(
    """SELECT l_discount, ROUND(SUM(l_quantity), 2) AS total_quantity FROM lineitem
       WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01'
         GROUP BY l_suppkey HAVING SUM(l_quantity) > (SELECT AVG(q) FROM
           (SELECT SUM(l_quantity) AS q FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' GROUP BY l_suppkey)))
       GROUP BY l_discount"""
)
def in_subquery_having(t: Tables) -> DataFrame:
    return sql_query(
        t.spark,
        """SELECT l_discount, ROUND(SUM(l_quantity), 2) AS total_quantity FROM lineitem
           WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_shipdate >= '1996-01-01'
             GROUP BY l_suppkey HAVING SUM(l_quantity) > (SELECT AVG(q) FROM
               (SELECT SUM(l_quantity) AS q FROM lineitem WHERE l_shipdate >= '1996-01-01' GROUP BY l_suppkey)))
           GROUP BY l_discount""",
        tables={"lineitem": t.path("lineitem")},
    )


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2046-01-01'")
def zero_rows_keep_schema(t: Tables) -> DataFrame:
    return scan(
        t.spark,
        t.path("orders"),
        columns=["o_orderkey", "o_totalprice"],
        filters="o_orderdate >= '2046-01-01'",
    )


# -- joins -------------------------------------------------------------------------------------------------------------


@query(
    """SELECT event_id, event_type, c_mktsegment FROM events JOIN customer ON user_id = c_custkey
       WHERE event_type = 'purchase'"""
)
def join_inner_drop_key(t: Tables) -> DataFrame:
    users = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    bought = t.events.filter("event_type = 'purchase'").select("event_id", "event_type", "user_id")
    return bought.join(users, "user_id").drop("user_id")


@query("SELECT l_orderkey, l_linenumber, l_quantity, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def join_inner_named_keys(t: Tables) -> DataFrame:
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "s_name"
    )


@query(
    """SELECT l.l_orderkey, l.l_suppkey, s.s_name, s.s_nationkey FROM lineitem l
       LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0 AND s_nationkey < 12) s ON l.l_suppkey = s.s_suppkey"""
)
def join_left_default(t: Tables) -> DataFrame:
    some = t.supplier.filter("s_acctbal > 0 AND s_nationkey < 12").select("s_suppkey", "s_name", "s_nationkey")
    lines = t.lineitem.select("l_orderkey", "l_suppkey")
    return lines.join(some, lines["l_suppkey"] == some["s_suppkey"], "left").drop("s_suppkey")


@query(
    """WITH spend AS (SELECT user_id, CAST(ts AS DATE) AS day, ROUND(SUM(value), 2) AS spent FROM events
         WHERE event_type = 'purchase' GROUP BY ALL),
       activity AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY ALL)
       SELECT a.user_id, a.day, a.n, s.spent FROM activity a LEFT JOIN spend s ON a.user_id = s.user_id AND a.day = s.day"""
)
def join_left_two_keys(t: Tables) -> DataFrame:
    dated = t.events.withColumn("day", F.to_date("ts"))
    spend = (
        dated.filter("event_type = 'purchase'")
        .groupBy("user_id", "day")
        .agg(F.round(F.sum("value"), 2).alias("spent"))
    )
    return dated.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n")).join(spend, ["user_id", "day"], "left")


@query(
    """SELECT COALESCE(e.user_id, c.c_custkey) AS user_id, e.event_id, c.c_name
       FROM (SELECT * FROM events WHERE event_type = 'signup') e FULL JOIN customer c ON e.user_id = c.c_custkey"""
)
def join_full_coalesced(t: Tables) -> DataFrame:
    signups = t.events.filter("event_type = 'signup'").select("user_id", "event_id")
    return full_by_key(signups, t.customer.select("c_custkey", "c_name"), "user_id", "c_custkey")


@query(
    """SELECT c_custkey, COUNT(o_orderkey) AS n FROM customer
       LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority NOT LIKE '%URGENT%' AND o_totalprice > 100000
       GROUP BY c_custkey"""
)
def join_left_extra_condition(t: Tables) -> DataFrame:
    # counted per customer before the join, so only one row per customer meets the other side
    counted = (
        t.orders.filter(~F.col("o_orderpriority").like("%URGENT%") & (F.col("o_totalprice") > 100000))
        .groupBy("o_custkey")
        .agg(F.count("o_orderkey").alias("counted"))
    )
    customers = t.customer.select("c_custkey")
    return customers.join(counted, customers["c_custkey"] == counted["o_custkey"], "left").select(
        "c_custkey", F.coalesce("counted", F.lit(0)).alias("n")
    )


@query(
    """SELECT r_name, n_name, COUNT(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name"""
)
def join_three_way(t: Tables) -> DataFrame:
    return (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name")
        .agg(F.count(F.lit(1)).alias("suppliers"))
    )


@query(
    """SELECT a.n_name AS nation_a, b.n_name AS nation_b FROM nation a JOIN nation b ON a.n_nationkey = b.n_regionkey"""
)
def join_self(t: Tables) -> DataFrame:
    a, b = t.nation.alias("a"), t.nation.alias("b")
    return a.join(b, F.col("a.n_nationkey") == F.col("b.n_regionkey")).select(
        F.col("a.n_name").alias("nation_a"), F.col("b.n_name").alias("nation_b")
    )


@query(
    "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey AND event_type = 'error')"
)
def join_semi(t: Tables) -> DataFrame:
    errors = t.events.filter("event_type = 'error'")
    return t.customer.join(errors, F.col("c_custkey") == F.col("user_id"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)")
def join_anti(t: Tables) -> DataFrame:
    return t.customer.join(t.events, F.col("c_custkey") == F.col("user_id"), "left_anti").select("c_custkey")


# -- aggregations ------------------------------------------------------------------------------------------------------


@query(
    """SELECT COUNT(*) AS documents, COUNT(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id)"""
)
def count_rows_and_values(t: Tables) -> DataFrame:
    return (
        t.documents.select("doc_id")
        .join(t.labels, "doc_id", "left")
        .agg(F.count(F.lit(1)).alias("documents"), F.count("quality").alias("labelled"))
    )


@query("SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def count_grouped(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT l_suppkey, ROUND(SUM(l_extendedprice * (1 - l_discount)), 4) AS net, SUM(l_quantity) / COUNT(l_quantity) AS avg_qty
       FROM lineitem GROUP BY l_suppkey"""
)
def sum_avg_expression(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(
        exact_sum(net(), 4).alias("net"), exact_mean("l_quantity", 0).alias("avg_qty")
    )


@query(
    """SELECT o_orderpriority, MIN(o_totalprice) AS lowest, MAX(o_totalprice) AS highest, MAX(o_orderdate) AS newest
       FROM orders GROUP BY o_orderpriority"""
)
def min_max_grouped(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(
        F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest"), F.max("o_orderdate").alias("newest")
    )


@query("SELECT l_suppkey, MEDIAN(l_extendedprice) AS median_price FROM lineitem GROUP BY l_suppkey")
def median_exact(t: Tables) -> DataFrame:
    return exact_median(t.lineitem, ["l_suppkey"], "l_extendedprice", "median_price")


@query(
    """SELECT COUNT(DISTINCT l_partkey) AS parts, COUNT(*) - COUNT(DISTINCT l_orderkey) AS repeated_orders FROM lineitem"""
)
def count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.count_distinct("l_partkey").alias("parts"),
        (F.count(F.lit(1)) - F.count_distinct("l_orderkey")).alias("repeated_orders"),
    )


@query(
    """SELECT user_id, COUNT(*) FILTER (WHERE event_type = 'signup') AS signups, COUNT(*) AS n FROM events GROUP BY user_id"""
)
def conditional_count(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "signup").alias("signups"), F.count(F.lit(1)).alias("n")
    )


@query(
    """SELECT o_custkey, 0::BIGINT AS piece_no, LIST(o_orderpriority ORDER BY o_orderpriority) AS priorities
       FROM orders GROUP BY o_custkey"""
)
def array_of_values(t: Tables) -> DataFrame:
    return ordered_lists(t.orders, ["o_custkey"], [], "o_orderpriority", "priorities")


@query(
    """SELECT o_custkey, 0::BIGINT AS piece_no, LIST(o_orderkey ORDER BY o_orderdate, o_orderkey) AS order_keys
       FROM orders GROUP BY o_custkey"""
)
def array_in_order(t: Tables) -> DataFrame:
    return ordered_lists(t.orders, ["o_custkey"], ["o_orderdate"], "o_orderkey", "order_keys")


@query("SELECT event_type, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1, 2 ORDER BY 1, 2")
def group_by_ordinal(t: Tables) -> DataFrame:
    return sql_query(
        t.spark,
        "SELECT event_type, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1, 2 ORDER BY 1, 2",
        tables={"events": t.path("events")},
    )


@query("SELECT lang, source, COUNT(*) AS n, CAST(SUM(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ALL")
def group_by_all(t: Tables) -> DataFrame:
    return sql_query(
        t.spark,
        "SELECT lang, source, COUNT(*) AS n, SUM(n_chars) AS chars FROM documents GROUP BY ALL",
        tables={"documents": t.path("documents")},
    )


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query(
    """SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey
       HAVING SUM(o_totalprice) > 3000000"""
)
def having(t: Tables) -> DataFrame:
    totals = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    return totals.filter("total > 3000000").withColumn("total", F.round("total", 2))


@query(
    """SELECT n, COUNT(*) AS customers FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) GROUP BY n"""
)
def distribution_of_counts(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per_customer.groupBy("n").agg(F.count(F.lit(1)).alias("customers"))


@query(
    """SELECT FLOOR(l_quantity / 10) * 10 AS bin, COUNT(*) AS n, ROUND(SUM(l_discount), 2) / COUNT(l_discount) AS avg_discount
       FROM lineitem GROUP BY bin"""
)
def binned_mean(t: Tables) -> DataFrame:
    return t.lineitem.groupBy((F.floor(F.col("l_quantity") / 10) * 10.0).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), exact_mean("l_discount").alias("avg_discount")
    )


@query(
    """SELECT DATE_TRUNC('hour', ts) AS hour, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY ALL"""
)
def time_buckets(t: Tables) -> DataFrame:
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    return t.events.groupBy(hour, F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH hourly AS (SELECT DATE_TRUNC('hour', ts) AS hour, event_type, COUNT(*) AS n, AVG(value) AS m,
         MIN(value) AS lo, MAX(value) AS hi FROM events GROUP BY ALL)
       SELECT event_type, CAST(SUM(n) AS BIGINT) AS readings, ROUND(AVG(m), 6) AS mean_of_means, MIN(lo) AS lowest,
         MAX(hi) AS highest FROM hourly GROUP BY event_type"""
)
def reaggregated_hours(t: Tables) -> DataFrame:
    hourly = t.events.groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    return hourly.groupBy("event_type").agg(
        F.sum("n").alias("readings"),
        F.round(F.avg("m"), 6).alias("mean_of_means"),
        F.min("lo").alias("lowest"),
        F.max("hi").alias("highest"),
    )


@query(
    """WITH b AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem)
       SELECT CAST(LEAST(FLOOR((l_extendedprice - lo) / ((hi - lo) / 60)), 59) AS BIGINT) AS bin, COUNT(*) AS n
       FROM lineitem, b GROUP BY bin"""
)
def histogram_60(t: Tables) -> DataFrame:
    return histogram(t.lineitem, "l_extendedprice", 60)


# -- numbering ---------------------------------------------------------------------------------------------------------


@query(
    """SELECT user_id, day, event_id, value FROM (SELECT user_id, DATE_TRUNC('day', ts) AS day, event_id, value,
         ROW_NUMBER() OVER (PARTITION BY user_id, DATE_TRUNC('day', ts) ORDER BY value DESC, event_id) AS rn FROM events)
       WHERE rn = 1"""
)
def dedupe_keep_highest(t: Tables) -> DataFrame:
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    keyed = t.events.select("user_id", day, "event_id", "value")
    return keep_best(keyed, ["user_id", "day"], "value", ties=[-F.col("event_id")])


@query("SELECT COUNT(*) AS n, 1::BIGINT AS first, COUNT(*) AS last, COUNT(*) AS different FROM lineitem")
def row_numbers_contiguous(t: Tables) -> DataFrame:
    numbered = number_rows(t.lineitem.select("l_orderkey"))
    return numbered.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("row_number").alias("first"),
        F.max("row_number").alias("last"),
        F.count_distinct("row_number").alias("different"),
    )


@query(
    """SELECT l_shipdate, l_partkey, l_suppkey, ROW_NUMBER() OVER (ORDER BY l_shipdate, l_partkey, l_suppkey) AS row_number
       FROM lineitem"""
)
def row_numbers_ordered(t: Tables) -> DataFrame:
    return number_ordered(t.lineitem.select("l_shipdate", "l_partkey", "l_suppkey"), ["l_shipdate"])


# -- order, limit, sample, sets ----------------------------------------------------------------------------------------


@query("SELECT o_orderpriority, o_orderkey, o_totalprice AS price FROM orders ORDER BY 1, price DESC, o_orderkey")
def order_by_several(t: Tables) -> DataFrame:
    return sql_query(
        t.spark,
        "SELECT o_orderpriority, o_orderkey, o_totalprice AS price FROM orders ORDER BY 1, price DESC, o_orderkey",
        tables={"orders": t.path("orders")},
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def order_limit(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    "SELECT l_partkey, COUNT(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 50"
)
def top_k_by_count(t: Tables) -> DataFrame:
    counted = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "l_partkey").limit(50)


@query(
    """SELECT * FROM (SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey DESC
       LIMIT 30) ORDER BY n, l_suppkey"""
)
def top_30_ascending(t: Tables) -> DataFrame:
    counted = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.desc("l_suppkey")).limit(30).orderBy("n", "l_suppkey")


@query(
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY MD5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey LIMIT 2000"""
)
def seeded_sample(t: Tables) -> DataFrame:
    return sample(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 2000, 42)


@query(
    """SELECT user_id AS key, 'added' AS change FROM (SELECT user_id FROM events EXCEPT SELECT c_custkey FROM customer
         WHERE c_mktsegment <> 'BUILDING') UNION ALL
       SELECT c_custkey, 'removed' FROM (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'
         EXCEPT SELECT user_id FROM events)"""
)
def set_difference_both_ways(t: Tables) -> DataFrame:
    before = t.customer.filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("key"))
    return diff_names(before, t.events.select(F.col("user_id").alias("key")), "key")


@query(
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer UNION ALL
       SELECT s_suppkey, s_name, s_acctbal FROM supplier"""
)
def concat_by_name(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers)


# -- scalar functions --------------------------------------------------------------------------------------------------


@query("SELECT n_nationkey, CONCAT(n_name, ' of region ', CAST(n_regionkey AS VARCHAR)) AS label FROM nation")
def concat_text(t: Tables) -> DataFrame:
    return t.nation.select(
        "n_nationkey", F.concat("n_name", F.lit(" of region "), F.col("n_regionkey").cast("string")).alias("label")
    )


@query("SELECT doc_id, SUBSTRING(text, 1, 10) AS head, LENGTH(text) AS length FROM documents")
def substring_head(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", F.substring("text", 1, 10).alias("head"), F.length("text").cast("long").alias("length")
    )


@query("SELECT doc_id, SPLIT_PART(text, '. ', 1) AS first_sentence FROM documents")
def text_before_marker(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", before_marker(F.col("text"), ". ").alias("first_sentence"))


@query(
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_totalprice > 100000 THEN 'medium'
       ELSE 'small' END AS size FROM orders"""
)
def case_when(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    size = F.when(price > 300000, "large").when(price > 100000, "medium").otherwise("small")
    return t.orders.select("o_orderkey", size.alias("size"))


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_custkey AS DOUBLE) AS customer,
       CAST(o_orderkey AS VARCHAR) AS order_text FROM orders"""
)
def casts(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_custkey").cast("double").alias("customer"),
        F.col("o_orderkey").cast("string").alias("order_text"),
    )


@query(
    """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS DOUBLE)
       AS reading FROM events"""
)
def try_cast(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("user_id").cast("string"))
    return t.events.select("event_id", text.try_cast("double").alias("reading"))


@query(
    """SELECT event_id, DATE_TRUNC('day', ts) AS day, DATE_TRUNC('hour', ts) AS hour, CAST(ts AS DATE) AS date FROM events"""
)
def date_truncation(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        F.to_date("ts").alias("date"),
    )


@query("SELECT event_id, ts + INTERVAL 5 HOUR AS utc FROM events")
def time_zone_to_utc(t: Tables) -> DataFrame:
    # the clock of a zone five hours behind, as UTC
    return t.events.select("event_id", F.to_utc_timestamp("ts", "-05:00").cast("timestamp_ntz").alias("utc"))


@query(
    """SELECT l_orderkey, l_linenumber, l_shipdate, CAST(EPOCH(l_shipdate - o_orderdate) / 60 AS BIGINT) AS minutes
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def minutes_between(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        whole_minutes(F.col("o_orderdate"), F.col("l_shipdate")).alias("minutes"),
    )


@query("SELECT event_id, ROUND(value, 1) AS rounded FROM events")
def round_values(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.round("value", 1).alias("rounded"))


@query(
    """SELECT p_partkey, ROUND(LOG10(p_retailprice), 9) AS log_price, FLOOR(p_retailprice / 7)::BIGINT AS sevenths,
       ROUND(p_retailprice * POW(1.03, 10), 6) AS grown FROM part"""
)
def log_floor_power(t: Tables) -> DataFrame:
    price = F.col("p_retailprice")
    return t.part.select(
        "p_partkey",
        F.round(F.log10(price), 9).alias("log_price"),
        F.floor(price / 7).alias("sevenths"),
        F.round(price * F.pow(F.lit(1.03), F.lit(10)), 6).alias("grown"),
    )


@query(
    """SELECT doc_id, COALESCE(CAST(quality AS VARCHAR), 'unknown') AS quality, COALESCE(toxic, 0) AS toxic
       FROM documents LEFT JOIN labels USING (doc_id)"""
)
def fill_nulls(t: Tables) -> DataFrame:
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return joined.withColumn("quality", F.col("quality").cast("string")).fillna({"quality": "unknown", "toxic": 0})


@query(
    """SELECT word, COUNT(*) AS n FROM (SELECT UNNEST(STRING_SPLIT(p_name, ' ')) AS word FROM part) GROUP BY word"""
)
def explode_list(t: Tables) -> DataFrame:
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, DATE_TRUNC('second', ts) AS parsed FROM events")
def parse_timestamp(t: Tables) -> DataFrame:
    text = F.date_format("ts", "yyyyMMddHHmmss")
    parsed = F.try_to_timestamp(text, F.lit(spark_pattern("%Y%m%d%H%M%S")))
    return t.events.select("event_id", parsed.cast("timestamp_ntz").alias("parsed"))


@query(
    """WITH n AS (SELECT STRFTIME(ts, '%Y/%m/%d') || ' ' || event_type || '#' || user_id AS label FROM events)
       SELECT REGEXP_EXTRACT(label, '^(\\d+)/(\\d+)/\\d+ (\\w+)#', 2) AS month, COUNT(*) AS n FROM n
       WHERE REGEXP_MATCHES(label, '^(\\d+)/(\\d+)/\\d+ (\\w+)#') GROUP BY 1"""
)
def regex_groups_counted(t: Tables) -> DataFrame:
    label = F.concat(F.date_format("ts", "yyyy/MM/dd"), F.lit(" "), "event_type", F.lit("#"), F.col("user_id").cast("string"))
    parsed = t.events.select(*named_groups(label, r"(\d+)/(\d+)/\d+ (\w+)#\d+", ["year", "month", "kind"]))
    return parsed.filter(F.col("month").isNotNull()).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, p_name FROM part WHERE REGEXP_MATCHES(p_name, '^(red|blue) .*t$')")
def regex_filter(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_name").rlike("^(red|blue) .*t$")).select("p_partkey", "p_name")

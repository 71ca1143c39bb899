"""The end-to-end cases: several steps each, on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import Tables, query
from tidemark.functions.numbers import exact_mean, exact_sum
from tidemark.functions.text import page_text
from tidemark.functions.times import whole_minutes
from tidemark.operators.joins import full_by_key
from tidemark.operators.ranks import exact_median, ordered_lists


@query(
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, s_name, s_nationkey,
         ROUND(LOG10(l_quantity), 9) AS log_quantity
       FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_shipdate >= TIMESTAMP '1997-06-15'
       AND l_shipdate < TIMESTAMP '1999-01-01' AND l_quantity > 0 AND l_quantity < 40"""
)
def trips_with_zones(t: Tables) -> DataFrame:
    trips = t.lineitem.filter((F.col("l_shipdate") >= "1997-06-15") & (F.col("l_shipdate") < "1999-01-01")).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_quantity"
    )
    zones = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    joined = trips.join(zones, F.col("l_suppkey") == F.col("s_suppkey"), "left").drop("l_suppkey", "s_suppkey")
    return joined.filter("l_quantity > 0 AND l_quantity < 40").withColumn(
        "log_quantity", F.round(F.log10("l_quantity"), 9)
    )


@query(
    """SELECT n_name, s_name, SUM(CAST(EPOCH(l_shipdate - o_orderdate) / 60 AS BIGINT)) / COUNT(*) AS avg_waiting_time
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name, s_name ORDER BY avg_waiting_time DESC"""
)
def waiting_time_by_zone(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate")
    waits = lines.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    minutes = whole_minutes(F.col("o_orderdate"), F.col("l_shipdate"))
    per_supplier = waits.groupBy("l_suppkey").agg(F.sum(minutes).alias("minutes"), F.count(F.lit(1)).alias("n"))
    zones = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return (
        per_supplier.join(zones, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("n_name", "s_name")
        .agg((F.sum("minutes") / F.sum("n")).alias("avg_waiting_time"))
        .orderBy(F.desc("avg_waiting_time"))
    )


@query(
    """SELECT SUBSTRING(CAST(ts AS VARCHAR), 1, 10) AS day, c_mktsegment, COUNT(*) AS purchases,
         ROUND(SUM(value), 2) AS revenue, ROUND(SUM(value), 2) / COUNT(value) AS mean_purchase
       FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase' AND value > 0 GROUP BY 1, 2"""
)
def daily_segment_stats(t: Tables) -> DataFrame:
    bought = t.events.filter("event_type = 'purchase' AND value > 0")
    # per user and day first: a heavy buyer is one row per day at the join
    daily = bought.groupBy(F.col("user_id").alias("c_custkey"), F.substring(F.col("ts").cast("string"), 1, 10).alias("day")).agg(
        F.count(F.lit(1)).alias("purchases"), exact_sum("value").alias("revenue")
    )
    per_segment = daily.join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey").groupBy("day", "c_mktsegment")
    sums = per_segment.agg(F.sum("purchases").alias("purchases"), exact_sum("revenue").alias("revenue"))
    return sums.withColumn("mean_purchase", F.col("revenue") / F.col("purchases"))


@query(
    """WITH shown AS (SELECT event_type, DATE_TRUNC('minute', ts) AS minute,
         CASE WHEN event_type = 'error' THEN 'err-' || value ELSE CAST(value AS VARCHAR) END AS reading FROM events),
       peaks AS (SELECT event_type, minute, MAX(TRY_CAST(reading AS DOUBLE)) AS peak FROM shown GROUP BY ALL)
       SELECT DATE_TRUNC('hour', minute) AS hour, event_type, COUNT(peak) AS minutes, ROUND(SUM(peak), 2) / COUNT(peak) AS mean_peak,
         MIN(peak) AS lowest_peak, MAX(peak) AS highest_peak FROM peaks WHERE peak IS NOT NULL GROUP BY ALL"""
)
def telemetry_bronze_to_gold(t: Tables) -> DataFrame:
    """Values as text, some of them no numbers; of the readable ones the highest of each minute, summed up by hour."""
    number = F.col("value").cast("string")
    shown = F.when(F.col("event_type") == "error", F.concat(F.lit("err-"), number)).otherwise(number)
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute")
    peaks = t.events.groupBy("event_type", minute).agg(F.max(shown.try_cast("double")).alias("peak")).filter("peak IS NOT NULL")
    return peaks.groupBy(F.date_trunc("hour", "minute").cast("timestamp_ntz").alias("hour"), "event_type").agg(
        F.count("peak").alias("minutes"),
        exact_mean("peak").alias("mean_peak"),
        F.min("peak").alias("lowest_peak"),
        F.max("peak").alias("highest_peak"),
    )


@query(
    """SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n_events, COUNT(*) FILTER (event_type = 'signup') AS n_signups,
         COUNT(*) FILTER (event_type = 'purchase') AS n_purchases, ROUND(SUM(value) FILTER (event_type = 'purchase'), 2) AS spent,
         ROUND(SUM(value) FILTER (event_type = 'purchase'), 2) / COUNT(value) FILTER (event_type = 'purchase') AS mean_purchase
       FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY ALL"""
)
def account_day_summary(t: Tables) -> DataFrame:
    """One pass: conditional counts and sums instead of two groupings and a join."""
    kind = F.col("event_type")
    paid = F.when(kind == "purchase", F.col("value"))
    days = t.events.filter((F.col("ts") >= "2024-01-05") & (F.col("ts") < "2024-01-25"))
    return days.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(kind == "signup").alias("n_signups"),
        F.count_if(kind == "purchase").alias("n_purchases"),
        exact_sum(paid).alias("spent"),
        exact_mean(paid).alias("mean_purchase"),
    )


@query(
    """SELECT q.conv_id AS question_id, q.text AS question_text, a.text AS answer_text, 0::BIGINT AS piece_no,
         LIST(t.role ORDER BY t.role) AS tags
       FROM conversations q JOIN conversations a ON q.conv_id = a.conv_id AND a.turn = q.turn + 1
       JOIN conversations t ON q.conv_id = t.conv_id WHERE q.role = 'user' AND a.role = 'assistant' GROUP BY ALL"""
)
def question_answer_tags(t: Tables) -> DataFrame:
    asked = t.conversations.filter("role = 'user'").select(
        "conv_id", F.col("turn").alias("asked"), F.col("text").alias("question_text")
    )
    answered = t.conversations.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("asked"), F.col("text").alias("answer_text")
    )
    pairs = asked.join(answered, ["conv_id", "asked"])
    # counts of pairs and of tags stand for their rows: the joined table has one row per pair and distinct tag
    pairs = pairs.groupBy("conv_id", "question_text", "answer_text").agg(F.count(F.lit(1)).alias("pairs"))
    tags = t.conversations.groupBy("conv_id", "role").agg(F.count(F.lit(1)).alias("tags"))
    joined = pairs.join(tags, "conv_id").select(
        F.col("conv_id").alias("question_id"),
        "question_text",
        "answer_text",
        "role",
        (F.col("pairs") * F.col("tags")).alias("copies"),
    )
    return ordered_lists(joined, ["question_id", "question_text", "answer_text"], [], "role", "tags", copies="copies")


@query(
    """SELECT l_orderkey AS playlist_id, 0::BIGINT AS piece_no, LIST(l_partkey ORDER BY l_linenumber, l_suppkey, l_partkey)
         AS track_ids FROM lineitem WHERE l_quantity > 5 GROUP BY l_orderkey"""
)
def playlist_sequences(t: Tables) -> DataFrame:
    return sequences(t).withColumnRenamed("l_orderkey", "playlist_id")


def sequences(t: Tables) -> DataFrame:
    tracks = t.lineitem.filter("l_quantity > 5")
    return ordered_lists(tracks, ["l_orderkey"], ["l_linenumber", "l_suppkey"], "l_partkey", "track_ids")


@query(
    """SELECT l_partkey AS track_id, COUNT(*) AS count FROM lineitem WHERE l_quantity > 5 GROUP BY l_partkey
       ORDER BY count DESC, track_id LIMIT 100"""
)
def popular_tracks(t: Tables) -> DataFrame:
    # unnesting the sequences gives the filtered rows back, so they are counted where they are
    tracks = t.lineitem.filter("l_quantity > 5").select(F.col("l_partkey").alias("track_id"))
    return (
        tracks.groupBy("track_id").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "track_id").limit(100)
    )


@query(
    """SELECT FLOOR(p_size / 10)::BIGINT AS size_bin, ROUND(AVG(CASE WHEN p_type = 'PROMO' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 9)
         AS promo_rate FROM part WHERE p_size IS NOT NULL GROUP BY size_bin ORDER BY size_bin"""
)
def rate_by_bin(t: Tables) -> DataFrame:
    return (
        t.part.filter("p_size IS NOT NULL")
        .groupBy(F.floor(F.col("p_size") / 10).alias("size_bin"))
        .agg(F.round(F.avg((F.col("p_type") == "PROMO").cast("double")), 9).alias("promo_rate"))
        .orderBy("size_bin")
    )


@query(
    """SELECT p_type, p_brand, ROUND(SUM(p_retailprice), 2) / COUNT(p_retailprice) AS avg_price, COUNT(*) AS n_parts FROM part GROUP BY ALL"""
)
def average_by_class(t: Tables) -> DataFrame:
    return t.part.groupBy("p_type", "p_brand").agg(
        exact_mean("p_retailprice").alias("avg_price"), F.count(F.lit(1)).alias("n_parts")
    )


@query(
    """SELECT s_name, ROUND(MEDIAN(LOG10(l_quantity)), 9) AS log_quantity FROM lineitem
       FULL JOIN supplier ON l_suppkey = s_suppkey WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_quantity > 0
       AND l_quantity < 40 GROUP BY s_name"""
)
def median_log_by_zone(t: Tables) -> DataFrame:
    trips = t.lineitem.select("l_suppkey", "l_shipdate", "l_quantity")
    joined = full_by_key(trips, t.supplier.select("s_suppkey", "s_name"), "l_suppkey", "s_suppkey")
    kept = joined.filter((F.col("l_shipdate") >= "1996-01-01") & (F.col("l_quantity") > 0) & (F.col("l_quantity") < 40))
    logs = kept.select("s_name", F.log10("l_quantity").alias("log_quantity"))
    return exact_median(logs, ["s_name"], "log_quantity", "log_quantity").withColumn(
        "log_quantity", F.round("log_quantity", 9)
    )


# Page parts without text, in the order they are removed, as DuckDB states them.
_PAGE_SQL = """TRIM(REGEXP_REPLACE(REPLACE(REPLACE(REPLACE(REPLACE(REPLACE(REPLACE(
  REGEXP_REPLACE(REGEXP_REPLACE(REGEXP_REPLACE(REGEXP_REPLACE(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'),
    '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[ \\t\\r\\n]+', ' ', 'g'))"""


@query(f"SELECT page_id, {_PAGE_SQL} AS text FROM pages")
def page_texts(t: Tables) -> DataFrame:
    return t.pages.select("page_id", page_text(F.col("html")).alias("text"))


@query(
    """SELECT REGEXP_EXTRACT(url, '^https?://([^/]+)', 1) AS company, lang, SUM(amount) / COUNT(amount) AS mean_amount, COUNT(*) AS n
       FROM (SELECT url, REGEXP_EXTRACT(html, '<html lang="([a-z]+)"', 1) AS lang,
         CAST(UNNEST(REGEXP_EXTRACT_ALL(html, 'ad (\\d+)', 1)) AS BIGINT) AS amount FROM pages) GROUP BY ALL"""
)
def mean_extracted_amount(t: Tables) -> DataFrame:
    amounts = t.pages.select(
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("company"),
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"),
        F.explode(F.regexp_extract_all("html", F.lit(r"ad (\d+)"), F.lit(1))).alias("amount"),
    )
    return amounts.groupBy("company", "lang").agg(
        exact_mean(F.col("amount").cast("long"), 0).alias("mean_amount"), F.count(F.lit(1)).alias("n")
    )

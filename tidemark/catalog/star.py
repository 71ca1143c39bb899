"""Business metrics over the order star schema.

Line-level sums are taken per join key first (order, supplier, customer), so what meets a dimension is one row per key, not
the lines. Dimensions are left to Spark's size-based choice between broadcast and shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import Tables, query
from tidemark.functions.numbers import exact_mean, exact_sum
from tidemark.sources.scan import query as sql_query


def gross() -> Column:
    return F.col("l_extendedprice")


def net() -> Column:
    return gross() * (1 - F.col("l_discount"))


def taxed() -> Column:
    return net() * (1 + F.col("l_tax"))


def nations(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )


@query(
    """SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS sum_qty, ROUND(SUM(l_extendedprice), 2) AS sum_base_price,
         ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
         ROUND(SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
         SUM(l_quantity) / COUNT(l_quantity) AS avg_qty, ROUND(SUM(l_extendedprice), 2) / COUNT(l_extendedprice) AS avg_price,
         ROUND(SUM(l_discount), 2) / COUNT(l_discount) AS avg_disc, COUNT(*) AS count_order
       FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY l_returnflag, l_linestatus
       ORDER BY l_returnflag, l_linestatus"""
)
def pricing_summary(t: Tables) -> DataFrame:
    return (
        t.lineitem.filter(F.col("l_shipdate") <= "1998-09-02")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.round(exact_sum(gross()), 2).alias("sum_base_price"),
            F.round(exact_sum(net(), 4), 2).alias("sum_disc_price"),
            F.round(exact_sum(taxed(), 6), 2).alias("sum_charge"),
            exact_mean("l_quantity", 0).alias("avg_qty"),
            exact_mean(gross()).alias("avg_price"),
            exact_mean("l_discount").alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


@query(
    """SELECT ROUND(SUM(l_extendedprice), 2) AS gross, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS net,
         ROUND(SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS net_after_tax,
         ROUND(SUM(l_extendedprice * l_discount), 2) AS discount_given FROM lineitem"""
)
def revenue_measures(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.round(exact_sum(gross()), 2).alias("gross"),
        F.round(exact_sum(net(), 4), 2).alias("net"),
        F.round(exact_sum(taxed(), 6), 2).alias("net_after_tax"),
        F.round(exact_sum(gross() * F.col("l_discount"), 4), 2).alias("discount_given"),
    )


@query(
    """WITH lines AS (SELECT l_orderkey, SUM(FLOOR(l_extendedprice * (1 - l_discount) * (1 + l_tax) * 100 + 1e-6))::BIGINT AS cents
         FROM lineitem GROUP BY l_orderkey)
       SELECT o_orderkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) - cents AS drift_cents FROM orders
       JOIN lines ON o_orderkey = l_orderkey WHERE CAST(ROUND(o_totalprice * 100) AS BIGINT) <> cents"""
)
def order_total_drift(t: Tables) -> DataFrame:
    # each line is cut to whole cents before summing; cents add up exactly in any order
    cents = F.floor(taxed() * 100 + 1e-6)
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum(cents).alias("cents"))
    total = F.round(F.col("o_totalprice") * 100).cast("long")
    return (
        t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .filter(total != F.col("cents"))
        .select("o_orderkey", (total - F.col("cents")).alias("drift_cents"))
    )


@query(
    """SELECT (SELECT ROUND(SUM(o_totalprice), 2) / COUNT(o_totalprice) FROM orders) AS average_order_value,
         (SELECT COUNT(*) FROM orders) AS order_volume, SUM(l_quantity) AS quantity_shipped,
         ROUND(AVG(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 10) AS return_rate FROM lineitem"""
)
def order_metrics(t: Tables) -> DataFrame:
    header = t.orders.agg(
        exact_mean("o_totalprice").alias("average_order_value"), F.count(F.lit(1)).alias("order_volume")
    )
    lines = t.lineitem.agg(
        F.sum("l_quantity").alias("quantity_shipped"),
        F.round(F.avg((F.col("l_returnflag") == "R").cast("double")), 10).alias("return_rate"),
    )
    both = header.unionByName(lines, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns])


@query(
    """SELECT r_name AS customer_region, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"""
)
def revenue_by_customer_region(t: Tables) -> DataFrame:
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(net()).alias("revenue"))
    per_customer = (
        per_order.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations(t), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("r_name").alias("customer_region"))
        .agg(F.round(F.sum("revenue"), 2).alias("revenue"))
    )


@query(
    """SELECT r_name AS supplier_region, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"""
)
def revenue_by_supplier_region(t: Tables) -> DataFrame:
    per_supplier = t.lineitem.groupBy("l_suppkey").agg(F.sum(net()).alias("revenue"))
    return (
        per_supplier.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations(t), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("r_name").alias("supplier_region"))
        .agg(F.round(F.sum("revenue"), 2).alias("revenue"))
    )


@query(
    """SELECT l_orderkey, ROUND(SUM(l_extendedprice * (1 - l_discount)), 4) AS revenue, o_orderdate, o_orderpriority
       FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
       WHERE c_mktsegment = 'BUILDING' AND o_orderdate < DATE '1998-03-15' AND l_shipdate > DATE '1998-03-15'
       GROUP BY ALL ORDER BY revenue DESC, o_orderdate, l_orderkey LIMIT 10"""
)
def shipping_priority(t: Tables) -> DataFrame:
    building = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    placed = t.orders.filter(F.col("o_orderdate") < "1998-03-15").join(
        building, F.col("o_custkey") == F.col("c_custkey"), "left_semi"
    )
    lines = (
        t.lineitem.filter(F.col("l_shipdate") > "1998-03-15")
        .groupBy("l_orderkey")
        .agg(F.round(F.sum(net()), 4).alias("revenue"))
    )
    return (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "revenue", "o_orderdate", "o_orderpriority")
        .orderBy(F.desc("revenue"), "o_orderdate", "l_orderkey")
        .limit(10)
    )


@query(
    """SELECT n_name, ROUND(SUM(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM customer
       JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' AND o_orderdate >= DATE '1996-01-01'
       AND o_orderdate < DATE '1999-01-01' GROUP BY n_name"""
)
def local_supplier_volume(t: Tables) -> DataFrame:
    asia = nations(t).filter("r_name = 'ASIA'")
    # lines of the region's suppliers, summed per order and nation before they meet the orders
    sellers = t.supplier.join(asia, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi").select("s_suppkey", "s_nationkey")
    lines = t.lineitem.select("l_orderkey", "l_suppkey", net().alias("revenue"))
    lines = lines.join(sellers, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_orderkey", "s_nationkey")
    lines = lines.agg(F.sum("revenue").alias("revenue"))
    placed = (
        t.orders.filter((F.col("o_orderdate") >= "1996-01-01") & (F.col("o_orderdate") < "1999-01-01"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    same = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("s_nationkey") == F.col("c_nationkey"))
    local = lines.join(placed, same)
    return (
        local.groupBy("c_nationkey")
        .agg(F.sum("revenue").alias("revenue"))
        .join(asia, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", F.round("revenue", 4).alias("revenue"))
    )


@query(
    """SELECT ROUND(SUM(l_extendedprice * l_discount), 4) AS revenue FROM lineitem WHERE l_shipdate >= DATE '1997-01-01'
       AND l_shipdate < DATE '1998-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24"""
)
def forecast_revenue_change(t: Tables) -> DataFrame:
    kept = t.lineitem.filter(
        (F.col("l_shipdate") >= "1997-01-01")
        & (F.col("l_shipdate") < "1998-01-01")
        & F.col("l_discount").between(0.05, 0.07)
        & (F.col("l_quantity") < 24)
    )
    return kept.agg(F.round(F.sum(gross() * F.col("l_discount")), 4).alias("revenue"))


@query(
    """SELECT s.n_name AS supp_nation, c.n_name AS cust_nation, YEAR(l_shipdate) AS l_year,
         ROUND(SUM(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM lineitem
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation s ON s_nationkey = s.n_nationkey JOIN nation c ON c_nationkey = c.n_nationkey
       WHERE ((s.n_name = 'NATION_1' AND c.n_name = 'NATION_2') OR (s.n_name = 'NATION_2' AND c.n_name = 'NATION_1'))
         AND l_shipdate BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY ALL"""
)
def volume_shipping(t: Tables) -> DataFrame:
    pair = t.nation.filter(F.col("n_name").isin("NATION_1", "NATION_2"))
    sellers = t.supplier.join(pair, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("supp_nation")
    )
    buyers = t.customer.join(pair, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("cust_nation")
    )
    lines = (
        t.lineitem.filter(F.col("l_shipdate").between("1996-01-01", "2000-12-31"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_orderkey", "supp_nation", F.year("l_shipdate").cast("long").alias("l_year"))
        .agg(F.sum(net()).alias("revenue"))
    )
    bought = t.orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "cust_nation")
    return (
        lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .filter("supp_nation <> cust_nation")
        .groupBy("supp_nation", "cust_nation", "l_year")
        .agg(F.round(F.sum("revenue"), 4).alias("revenue"))
    )


@query(
    """SELECT YEAR(o_orderdate) AS o_year, ROUND(SUM(CASE WHEN s.n_name = 'NATION_2' THEN l_extendedprice * (1 - l_discount)
         ELSE 0 END) / SUM(l_extendedprice * (1 - l_discount)), 9) AS share FROM lineitem
       JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation c ON c_nationkey = c.n_nationkey JOIN region ON c.n_regionkey = r_regionkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey
       WHERE r_name = 'ASIA' AND p_type = 'ECONOMY' GROUP BY o_year"""
)
def national_market_share(t: Tables) -> DataFrame:
    economy = t.part.filter("p_type = 'ECONOMY'").select("p_partkey")
    sellers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", (F.col("n_name") == "NATION_2").alias("wanted")
    )
    revenue = F.sum(net())
    lines = (
        t.lineitem.join(economy, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_orderkey")
        .agg(F.sum(F.when(F.col("wanted"), net()).otherwise(0.0)).alias("wanted"), revenue.alias("whole"))
    )
    asian = t.customer.join(
        nations(t).filter("r_name = 'ASIA'"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    placed = t.orders.join(asian, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.year("o_orderdate").cast("long").alias("o_year"))
        .agg(F.round(F.sum("wanted") / F.sum("whole"), 9).alias("share"))
    )


@query(
    """SELECT n_name AS nation, YEAR(o_orderdate) AS o_year, ROUND(SUM(l_extendedprice * (1 - l_discount)), 4) AS revenue
       FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN orders ON l_orderkey = o_orderkey JOIN nation ON s_nationkey = n_nationkey
       WHERE p_name LIKE '%red%' GROUP BY ALL"""
)
def product_type_revenue(t: Tables) -> DataFrame:
    red = t.part.filter(F.col("p_name").like("%red%")).select("p_partkey")
    sellers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("nation")
    )
    lines = (
        t.lineitem.join(red, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_orderkey", "nation")
        .agg(F.sum(net()).alias("revenue"))
    )
    dated = t.orders.select("o_orderkey", F.year("o_orderdate").cast("long").alias("o_year"))
    return (
        lines.join(dated, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("nation", "o_year")
        .agg(F.round(F.sum("revenue"), 4).alias("revenue"))
    )


@query(
    """SELECT c_custkey, c_name, ROUND(SUM(l_extendedprice * (1 - l_discount)), 4) AS revenue, c_acctbal, n_name FROM customer
       JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey
       WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1997-07-01' AND l_returnflag = 'R'
       GROUP BY ALL ORDER BY revenue DESC, c_custkey LIMIT 20"""
)
def returned_items(t: Tables) -> DataFrame:
    lines = t.lineitem.filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.sum(net()).alias("revenue"))
    placed = t.orders.filter((F.col("o_orderdate") >= "1997-01-01") & (F.col("o_orderdate") < "1997-07-01"))
    per_customer = (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.round(F.sum("revenue"), 4).alias("revenue"))
        .orderBy(F.desc("revenue"), "o_custkey")
        .limit(20)
    )
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "revenue", "c_acctbal", "n_name")
        .orderBy(F.desc("revenue"), "c_custkey")
    )


@query(
    """SELECT n AS c_count, COUNT(*) AS custdist FROM (SELECT c_custkey, COUNT(o_orderkey) AS n FROM customer
         LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority NOT LIKE '%URGENT%' GROUP BY c_custkey)
       GROUP BY n ORDER BY custdist DESC, c_count DESC"""
)
def customer_distribution(t: Tables) -> DataFrame:
    return sql_query(
        t.spark,
        """SELECT c_count, COUNT(*) AS custdist FROM (
             SELECT c_custkey, COUNT(o_orderkey) AS c_count FROM customer
             LEFT OUTER JOIN orders ON c_custkey = o_custkey AND o_orderpriority NOT LIKE '%URGENT%'
             GROUP BY c_custkey)
           GROUP BY c_count ORDER BY custdist DESC, c_count DESC""",
        tables={"customer": t.path("customer"), "orders": t.path("orders")},
    )


@query(
    """SELECT ROUND(100.0::DOUBLE * SUM(CASE WHEN p_type LIKE 'PROMO%' THEN l_extendedprice * (1 - l_discount) ELSE 0 END)
         / SUM(l_extendedprice * (1 - l_discount)), 8) AS promo_revenue FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_shipdate >= DATE '1997-09-01' AND l_shipdate < DATE '1997-10-01'"""
)
def promotion_effect(t: Tables) -> DataFrame:
    per_part = (
        t.lineitem.filter((F.col("l_shipdate") >= "1997-09-01") & (F.col("l_shipdate") < "1997-10-01"))
        .groupBy("l_partkey")
        .agg(F.sum(net()).alias("revenue"))
    )
    joined = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    promo = F.sum(F.when(F.col("p_type").like("PROMO%"), F.col("revenue")).otherwise(0.0))
    return joined.agg(F.round(100.0 * promo / F.sum("revenue"), 8).alias("promo_revenue"))


@query(
    """SELECT c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice, SUM(l_quantity) AS quantity FROM customer
       JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
       WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING SUM(l_quantity) > 200)
       GROUP BY ALL ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 100"""
)
def large_volume_customers(t: Tables) -> DataFrame:
    # the quantity found for the HAVING is the one reported, so lineitem is read once
    large = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity")).filter("quantity > 200")
    return (
        large.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_name", "c_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "quantity")
        .orderBy(F.desc("o_totalprice"), "o_orderdate", "o_orderkey")
        .limit(100)
    )

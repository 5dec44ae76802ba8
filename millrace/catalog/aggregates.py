"""Grouping and aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import big, day, money, order_values, ratio, real
from millrace.catalog.sources import ORDER_LINES_SQL
from millrace.operators import aggregates as A
from millrace.plans.ordered import with_group_totals
from millrace.registry import query
from millrace.sources.documents import order_json, order_lines


def raw_data(t):
    """Sales rows with region, category, a nullable amount and a date."""
    sold = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    sold = sold.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    sold = sold.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    amount = F.when(F.col("o_orderpriority") != "5-LOW", money("o_totalprice"))
    return sold.select(
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("category"),
        amount.alias("amount"),
        F.to_date("o_orderdate").alias("sales_date"),
    )


RAW = """
SELECT r_name AS region, c_mktsegment AS category,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount,
       CAST(o_orderdate AS DATE) AS sales_date
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
"""

BASIC_SQL = """
COUNT(*) AS n_rows, COUNT(amount) AS n_known, CAST(SUM(amount) AS DOUBLE) AS total,
CAST(MIN(amount) AS DOUBLE) AS low, CAST(MAX(amount) AS DOUBLE) AS high,
CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS mean
"""


def basic(amount="amount"):
    known = F.count(amount)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        known.alias("n_known"),
        real(F.sum(amount)).alias("total"),
        real(F.min(amount)).alias("low"),
        real(F.max(amount)).alias("high"),
        ratio(F.sum(amount), known).alias("mean"),
    ]


@query("global_aggregate", oracle=f"SELECT {BASIC_SQL} FROM ({RAW})")
def global_aggregate(t):
    return raw_data(t).agg(*basic())


@query(
    "avg_type_semantics",
    oracle="""
    SELECT l_returnflag, CAST(SUM(q) // COUNT(q) AS BIGINT) AS int_avg, CAST(SUM(q) AS DOUBLE) / COUNT(q) AS num_avg,
           CAST(SUM(q) // COUNT(*) AS BIGINT) AS avg_over_all_rows
    FROM (SELECT l_returnflag, CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) END AS q FROM lineitem)
    GROUP BY l_returnflag
    """,
)
def avg_type_semantics(t):
    """AVG of integers truncates; dividing by COUNT(*) counts the NULL rows too."""
    return t.sql(
        """
        SELECT l_returnflag, sum(q) div count(q) AS int_avg, cast(sum(q) AS double) / count(q) AS num_avg,
               sum(q) div count(*) AS avg_over_all_rows
        FROM (SELECT l_returnflag, CASE WHEN l_linenumber <> 7 THEN cast(l_quantity AS bigint) END AS q FROM {lineitem})
        GROUP BY l_returnflag
        """
    )


@query(
    "stddev_var",
    oracle="""
    SELECT l_returnflag, round(stddev_pop(l_quantity), 6) AS stdevp, round(var_pop(l_quantity), 6) AS varp,
           round(stddev_samp(l_quantity), 6) AS stdev, round(var_samp(l_quantity), 6) AS var
    FROM lineitem GROUP BY l_returnflag
    """,
)
def stddev_var(t):
    q = F.col("l_quantity")
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.stddev_pop(q), 6).alias("stdevp"),
        F.round(F.var_pop(q), 6).alias("varp"),
        F.round(F.stddev_samp(q), 6).alias("stdev"),
        F.round(F.var_samp(q), 6).alias("var"),
    )


@query("group_by_column", oracle=f"SELECT category, {BASIC_SQL} FROM ({RAW}) WHERE region <> 'ASIA' GROUP BY category")
def group_by_column(t):
    return raw_data(t).where(F.col("region") != "ASIA").groupBy("category").agg(*basic())


@query(
    "group_by_expression",
    oracle=f"""
    SELECT CAST(year(sales_date) AS BIGINT) AS yr, CAST(quarter(sales_date) AS BIGINT) AS qtr, {BASIC_SQL}
    FROM ({RAW}) GROUP BY 1, 2
    """,
)
def group_by_expression(t):
    parts = [big(F.year("sales_date")).alias("yr"), big(F.quarter("sales_date")).alias("qtr")]
    return raw_data(t).groupBy(*parts).agg(*basic())


@query(
    "group_with_attributes",
    oracle="""
    SELECT n_nationkey, n_name, total FROM
      (SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2)
    """,
)
def group_with_attributes(t):
    """Aggregate on the key, then fetch the name: the join sees one row per key."""
    totals = t.customer.groupBy("c_nationkey").agg(real(F.sum(money("c_acctbal"))).alias("total"))
    named = totals.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return named.select(big("n_nationkey").alias("n_nationkey"), "n_name", "total")


@query(
    "having",
    oracle="""
    SELECT o_custkey, COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 12 AND SUM(CAST(o_totalprice AS DECIMAL(18,2))) > 3000000
    """,
)
def having(t):
    sums = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(money("o_totalprice")).alias("s")
    )
    kept = sums.where((F.col("n_orders") >= 12) & (F.col("s") > 3000000))
    return kept.select("o_custkey", "n_orders", real("s").alias("total"))


@query(
    "count_distinct",
    oracle="SELECT CAST(year(o_orderdate) AS BIGINT) AS yr, COUNT(DISTINCT o_custkey) AS custs FROM orders GROUP BY 1",
)
def count_distinct(t):
    return t.orders.groupBy(big(F.year("o_orderdate")).alias("yr")).agg(F.count_distinct("o_custkey").alias("custs"))


@query(
    "multi_count_distinct",
    oracle="""
    SELECT l_returnflag, COUNT(DISTINCT l_suppkey) AS supps, COUNT(DISTINCT l_partkey) AS parts,
           COUNT(DISTINCT l_shipdate) AS days, COUNT(*) AS n_lines
    FROM lineitem GROUP BY l_returnflag
    """,
)
def multi_count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("supps"),
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_shipdate").alias("days"),
        F.count(F.lit(1)).alias("n_lines"),
    )


@query(
    "group_by_all",
    oracle="""
    SELECT c_custkey, COUNT(v) AS n_rows, CAST(SUM(v) AS DOUBLE) AS total, CAST(MAX(v) AS DOUBLE) AS high FROM
      (SELECT o_custkey AS c_custkey, CASE WHEN o_totalprice > 300000 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS v FROM orders)
    GROUP BY c_custkey
    """,
)
def group_by_all(t):
    rows = t.orders.select(F.col("o_custkey").alias("c_custkey"), money("o_totalprice").alias("v"), "o_totalprice")
    v = F.col("v")
    out = A.group_by_all(
        rows, ["c_custkey"], F.col("o_totalprice") > 300000, n_rows=("count", v), total=("sum", v), high=("max", v)
    )
    return out.select("c_custkey", "n_rows", real("total").alias("total"), real("high").alias("high"))


@query(
    "nested_aggregate_argmax",
    oracle=f"""
    WITH q AS (SELECT year(sales_date) AS yr, quarter(sales_date) AS qtr, category, COUNT(*) AS n FROM ({RAW}) GROUP BY 1, 2, 3)
    SELECT CAST(yr AS BIGINT) AS yr, CAST(qtr AS BIGINT) AS qtr, category, n FROM q
    WHERE n = (SELECT MAX(n) FROM q i WHERE i.yr = q.yr AND i.qtr = q.qtr)
    """,
)
def nested_aggregate_argmax(t):
    grouped = (
        raw_data(t)
        .groupBy(big(F.year("sales_date")).alias("yr"), big(F.quarter("sales_date")).alias("qtr"), "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return A.arg_max(grouped, ["yr", "qtr"], "n").select("yr", "qtr", "category", "n")


@query(
    "conditional_count_guard",
    oracle="""
    SELECT user_id, COUNT(*) AS n_events, COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS n_errors,
           CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS bought
    FROM events GROUP BY user_id HAVING COUNT(CASE WHEN event_type = 'error' THEN 1 END) > 12
    """,
)
def conditional_count_guard(t):
    bought = F.when(F.col("event_type") == "purchase", money("value")).otherwise(F.lit(0))
    sums = t.events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("event_type") == "error").alias("n_errors"),
        real(F.sum(bought)).alias("bought"),
    )
    return sums.where(F.col("n_errors") > 12)


LABELLED_SQL = """
CASE WHEN GROUPING(region) = 1 THEN 'All regions' ELSE region END AS region,
CASE WHEN GROUPING(category) = 1 THEN 'All categories' ELSE category END AS category,
CAST(GROUPING(region) * 2 + GROUPING(category) AS BIGINT) AS gid,
COUNT(*) AS n_rows, CAST(SUM(amount) AS DOUBLE) AS total
"""


def _labelled(grouped):
    whole_r, whole_c = F.grouping("region") == 1, F.grouping("category") == 1
    summed = grouped.agg(
        F.when(whole_r, "All regions").otherwise(F.col("region")).alias("r"),
        F.when(whole_c, "All categories").otherwise(F.col("category")).alias("c"),
        big(F.grouping_id()).alias("gid"),
        F.count(F.lit(1)).alias("n_rows"),
        real(F.sum("amount")).alias("total"),
    )
    return summed.select(F.col("r").alias("region"), F.col("c").alias("category"), "gid", "n_rows", "total")


@query("rollup", oracle=f"SELECT {LABELLED_SQL} FROM ({RAW}) r GROUP BY ROLLUP (region, category)")
def rollup(t):
    return _labelled(raw_data(t).rollup("region", "category"))


@query("cube", oracle=f"SELECT {LABELLED_SQL} FROM ({RAW}) r GROUP BY CUBE (region, category)")
def cube(t):
    return _labelled(raw_data(t).cube("region", "category"))


@query(
    "grouping_sets",
    oracle=f"SELECT {LABELLED_SQL} FROM ({RAW}) r GROUP BY GROUPING SETS ((region), (category), ())",
)
def grouping_sets(t):
    sets = [[F.col("region")], [F.col("category")], []]
    return _labelled(raw_data(t).groupingSets(sets, "region", "category"))


@query(
    "string_aggregate",
    oracle="""
    SELECT p_type, string_agg(p_brand, ', ' ORDER BY p_brand) AS brands FROM (SELECT DISTINCT p_type, p_brand FROM part)
    GROUP BY p_type
    """,
)
def string_aggregate(t):
    return t.part.groupBy("p_type").agg(A.ordered_list(F.col("p_brand"), ", ").alias("brands"))


@query(
    "array_aggregate_json",
    oracle=f"""
    SELECT orderid, '[' || string_agg('{{"line":' || linenumber || ',"item":{{"id":' || productid || ',"qty":' ||
           CAST(qty AS BIGINT) || '}}}}', ',' ORDER BY linenumber) || ']' AS items
    FROM ({ORDER_LINES_SQL}) GROUP BY orderid
    """,
)
def array_aggregate_json(t):
    return order_json(order_lines(t.lineitem))


@query(
    "percent_of_group_total",
    oracle="""
    SELECT o_orderkey, 100.0 * v / g AS pct_cust, 100.0 * v / a AS pct_all FROM
      (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS v,
              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS g,
              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER () AS DOUBLE) AS a FROM orders)
    """,
)
def percent_of_group_total(t):
    rows = order_values(t)
    grand = rows.agg(real(F.sum("val"))).scalar()
    rows = with_group_totals(rows, ["o_custkey"], cust=F.sum("val"))
    share = lambda whole: F.lit(100.0) * real("val") / whole
    return rows.select("o_orderkey", share(real("cust")).alias("pct_cust"), share(grand).alias("pct_all"))


@query(
    "agg_order_by",
    oracle="""
    SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey
    """,
)
def agg_order_by(t):
    totals = t.orders.groupBy("o_custkey").agg(real(F.sum(money("o_totalprice"))).alias("total"))
    return totals.orderBy(F.desc("total"), "o_custkey")


@query(
    "group_by_date_trunc",
    oracle="""
    SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY CAST(ts AS DATE)
    """,
)
def group_by_date_trunc(t):
    days = t.events.groupBy(F.to_date("ts").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), real(F.sum(money("value"))).alias("total")
    )
    return days.select(day("d").alias("day"), "n", "total")


@query(
    "ratio_of_sums",
    oracle="""
    SELECT l_suppkey, COUNT(DISTINCT l_partkey) AS n_parts,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS unit_price,
           CAST(SUM(CAST(l_quantity AS BIGINT)) // COUNT(*) AS BIGINT) AS whole_qty
    FROM lineitem GROUP BY l_suppkey
    """,
)
def ratio_of_sums(t):
    return t.sql(
        """
        SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts,
               cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double)
                 / cast(sum(cast(l_quantity AS decimal(18,2))) AS double) AS unit_price,
               sum(cast(l_quantity AS bigint)) div count(*) AS whole_qty
        FROM {lineitem} GROUP BY l_suppkey
        """
    )

"""Joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.catalog.common import SUPPLIER_MONTHS_SQL, big, day, money, real, supplier_months
from millrace.operators import joins as J
from millrace.registry import query
from millrace.sources.tables import materialise

def latest():
    return [F.desc("o_orderdate"), F.desc("o_orderkey")]


@query(
    "inner_join",
    oracle="SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def inner_join(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "c_mktsegment"
    )


@query(
    "multiway_join",
    oracle="""
    SELECT DISTINCT c_name, s_name FROM customer JOIN orders ON o_custkey = c_custkey
      JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    """,
)
def multiway_join(t):
    """DISTINCT runs on the keys, which are narrow; names are added afterwards."""
    lines = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    pairs = t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_suppkey").distinct()
    named = pairs.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return named.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("c_name", "s_name").distinct()


@query(
    "bushy_join",
    oracle="""
    SELECT n_name, COUNT(*) AS n_lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM (customer JOIN nation ON c_nationkey = n_nationkey)
      JOIN (orders JOIN lineitem ON l_orderkey = o_orderkey) ON o_custkey = c_custkey
    GROUP BY n_name
    """,
)
def bushy_join(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    sales = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        people.join(sales, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("n_name")
        .agg(F.count(F.lit(1)).alias("n_lines"), real(F.sum(money("l_extendedprice"))).alias("total"))
    )


@query(
    "left_outer_join",
    oracle="""
    SELECT o_orderkey, CAST(l_linenumber AS BIGINT) AS line FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    """,
)
def left_outer_join(t):
    lines = J.left_outer_join(t.orders, t.lineitem, "o_orderkey", "l_orderkey")
    return lines.select("o_orderkey", big("l_linenumber").alias("line"))


@query(
    "right_outer_join",
    oracle="""
    SELECT p_partkey, l_orderkey FROM lineitem RIGHT JOIN part ON l_partkey = p_partkey
    """,
)
def right_outer_join(t):
    """The right side is the preserved one: a left join with the sides exchanged."""
    return J.left_outer_join(t.part, t.lineitem, "p_partkey", "l_partkey").select("p_partkey", "l_orderkey")


@query(
    "left_outer_to_inner_group",
    oracle="""
    SELECT c_custkey, o_orderkey, p_name FROM customer LEFT JOIN
      (orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey)
      ON o_custkey = c_custkey
    """,
)
def left_outer_to_inner_group(t):
    inner = (
        t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .select("o_custkey", "o_orderkey", "p_name")
    )
    return J.left_outer_join(t.customer, inner, "c_custkey", "o_custkey").select("c_custkey", "o_orderkey", "p_name")


@query(
    "cross_join",
    oracle="""
    SELECT s_suppkey, CAST(y.orderyear AS BIGINT) AS orderyear
    FROM supplier CROSS JOIN (VALUES (1995), (1996), (1997)) AS y(orderyear)
    """,
)
def cross_join(t):
    """Rows times a written-out list of three values, so the output is bounded."""
    years = t.spark.createDataFrame([(1995,), (1996,), (1997,)], "orderyear bigint")
    return t.supplier.select("s_suppkey").crossJoin(F.broadcast(years))


@query(
    "self_join_prior_period",
    oracle="""
    WITH y AS (SELECT year(o_orderdate) AS yr, COUNT(DISTINCT o_custkey) AS n FROM orders GROUP BY 1)
    SELECT CAST(c.yr AS BIGINT) AS yr, c.n AS cur_custs, p.n AS prev_custs, c.n - p.n AS growth
    FROM y c LEFT JOIN y p ON c.yr = p.yr + 1
    """,
)
def self_join_prior_period(t):
    cur = t.orders.groupBy(F.year("o_orderdate").alias("yr")).agg(F.count_distinct("o_custkey").alias("cur_custs"))
    prev = cur.select((F.col("yr") + 1).alias("yr"), F.col("cur_custs").alias("prev_custs"))
    return cur.join(prev, "yr", "left").select(
        big("yr").alias("yr"), "cur_custs", "prev_custs", (F.col("cur_custs") - F.col("prev_custs")).alias("growth")
    )


@query(
    "equi_plus_theta_join",
    oracle="""
    SELECT o_orderkey, CAST(l_linenumber AS BIGINT) AS line, c_custkey, s_suppkey
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
      JOIN customer ON c_custkey = o_custkey AND c_nationkey <> s_nationkey
    """,
)
def equi_plus_theta_join(t):
    sold = (
        t.lineitem.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    abroad = (F.col("c_custkey") == F.col("o_custkey")) & (F.col("c_nationkey") != F.col("s_nationkey"))
    return sold.join(t.customer, abroad).select(
        "o_orderkey", big("l_linenumber").alias("line"), "c_custkey", "s_suppkey"
    )


@query(
    "nonequi_self_join",
    oracle="""
    WITH d AS (SELECT CAST(l_shipdate AS DATE) AS d, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS qty FROM lineitem GROUP BY 1)
    SELECT strftime(a.d, '%Y-%m-%d') AS shipdate, CAST(SUM(b.qty) AS DOUBLE) AS running
    FROM d a JOIN d b ON a.d >= b.d GROUP BY a.d
    """,
)
def nonequi_self_join(t):
    """The running total a theta self join gives, over days: first one row per
    day, so the single ordered window holds only calendar days."""
    days = t.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(F.sum(money("l_quantity")).alias("qty"))
    total = F.sum("qty").over(W.orderBy("d").rowsBetween(W.unboundedPreceding, 0))
    return days.select(day("d").alias("shipdate"), real(total).alias("running"))


@query(
    "interval_join",
    oracle=f"""
    WITH e AS ({SUPPLIER_MONTHS_SQL})
    SELECT a.empid, strftime(a.ordmonth, '%Y-%m-%d') AS ordmonth, CAST(SUM(b.qty) AS DOUBLE) AS qty3, COUNT(*) AS months
    FROM e a JOIN e b ON a.empid = b.empid AND b.ordmonth BETWEEN a.ordmonth - INTERVAL 2 MONTH AND a.ordmonth
    GROUP BY a.empid, a.ordmonth
    """,
)
def interval_join(t):
    """Key equality and a month range: a month counts from its own to the second after it."""
    months = materialise(supplier_months(t), "supplier-months")
    counted = months.select(
        F.col("empid").alias("key"), F.col("ordmonth").alias("begins"), F.add_months("ordmonth", 2).alias("ends"), "qty"
    )
    asked = months.select(F.col("empid").alias("key"), "ordmonth")
    met = J.points_in_intervals(asked, counted, "ordmonth", "begins", "ends", ["key"])
    sums = met.groupBy("key", "ordmonth").agg(real(F.sum("qty")).alias("qty3"), F.count(F.lit(1)).alias("months"))
    return sums.select(F.col("key").alias("empid"), day("ordmonth").alias("ordmonth"), "qty3", "months")


@query(
    "asof_prior_lookup",
    oracle="""
    SELECT e.event_id, e.user_id, p.event_id AS prior_event_id, p.value AS prior_value
    FROM events e LEFT JOIN LATERAL (
      SELECT i.event_id, i.value FROM events i
      WHERE i.user_id = e.user_id AND i.event_type = 'purchase' AND i.ts < e.ts
      ORDER BY i.ts DESC, i.event_id DESC LIMIT 1) p ON TRUE
    WHERE e.event_type <> 'purchase'
    """,
)
def asof_prior_lookup(t):
    bought = F.col("event_type") == "purchase"
    found = J.asof_join(
        t.events.where(~bought).select("event_id", "user_id", "ts"),
        t.events.where(bought).select("event_id", "user_id", "ts", "value"),
        ["user_id"], "ts", "event_id", ["event_id", "value"],
    )
    return found.select("event_id", "user_id", "prior_event_id", "prior_value")


@query(
    "semi_join",
    oracle="""
    SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
)
def semi_join(t):
    """Orders with lines."""
    with_lines = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return with_lines.select("o_orderkey", "o_custkey")


@query(
    "anti_join",
    oracle="""
    SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
)
def anti_join(t):
    """Orders without lines."""
    without = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    return without.select("o_orderkey", "o_custkey")


@query(
    "star_join_agg",
    oracle="""
    SELECT n_name, p_brand, CAST(year(l_shipdate) AS BIGINT) AS yr, COUNT(*) AS n_lines,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
      JOIN part ON p_partkey = l_partkey
    WHERE p_type IN ('ECONOMY', 'PROMO') AND l_shipdate >= TIMESTAMP '1998-01-01'
    GROUP BY n_name, p_brand, year(l_shipdate)
    """,
)
def star_join_agg(t):
    return t.sql(
        """
        SELECT n_name, p_brand, cast(year(l_shipdate) AS bigint) AS yr, count(*) AS n_lines,
               cast(sum(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(4,2)))) AS double) AS revenue
        FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey JOIN {nation} ON n_nationkey = s_nationkey
          JOIN {part} ON p_partkey = l_partkey
        WHERE p_type IN ('ECONOMY', 'PROMO') AND l_shipdate >= timestamp_ntz '1998-01-01'
        GROUP BY n_name, p_brand, year(l_shipdate)
        """
    )


@query(
    "lateral_topn",
    oracle="""
    SELECT c_custkey, o.o_orderkey, rn FROM customer JOIN
      (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
       FROM orders) o ON o.o_custkey = c_custkey AND rn <= 3
    """,
)
def lateral_topn(t):
    return J.lateral_top_n(t.customer, t.orders, "c_custkey", "o_custkey", latest(), 3).select(
        "c_custkey", "o_orderkey", "rn"
    )


@query(
    "outer_lateral_topn",
    oracle="""
    SELECT c_custkey, o.o_orderkey FROM customer LEFT JOIN
      (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
       FROM orders) o ON o.o_custkey = c_custkey AND rn <= 3
    """,
)
def outer_lateral_topn(t):
    return J.lateral_top_n(t.customer, t.orders, "c_custkey", "o_custkey", latest(), 3, outer=True).select(
        "c_custkey", "o_orderkey"
    )


@query(
    "lateral_scalar_agg",
    oracle="""
    SELECT c_custkey, COUNT(DISTINCT o_orderpriority) AS n_priorities FROM customer LEFT JOIN
      (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
       FROM orders) o ON o.o_custkey = c_custkey AND rn <= 10
    GROUP BY c_custkey
    """,
)
def lateral_scalar_agg(t):
    last = J.top_n_per_group(t.orders, ["o_custkey"], latest(), 10)
    counts = last.groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("n"))
    joined = t.customer.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_priorities"))


@query(
    "list_param_join",
    oracle="""
    SELECT pos, p_partkey, p_name FROM part JOIN (VALUES (1, 20), (2, 3), (3, 144), (4, 7)) AS l(p, id)
      ON p_partkey = id, LATERAL (SELECT CAST(p AS BIGINT) AS pos)
    """,
)
def list_param_join(t):
    ids = J.id_list(t.spark, "20,3,144,7")
    return J.join_id_list(t.part, "p_partkey", ids).select("pos", "p_partkey", "p_name").orderBy("pos")


@query(
    "join_hints",
    oracle="""
    SELECT hint, c_mktsegment, COUNT(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey,
      (VALUES ('merge'), ('shuffle_hash')) AS h(hint)
    GROUP BY hint, c_mktsegment
    UNION ALL
    SELECT 'broadcast', n_name, COUNT(*) FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
    """,
)
def join_hints(t):
    """The same join under two algorithms; broadcast is asked for on nation, whose
    size is fixed. The nested-loop hint is left out: it would make a product."""

    def count_by_segment(hint):
        joined = t.orders.join(t.customer.hint(hint), F.col("o_custkey") == F.col("c_custkey"))
        return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders")).withColumn("hint", F.lit(hint))

    small = (
        t.customer.join(t.nation.hint("broadcast"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("c_mktsegment"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
        .withColumn("hint", F.lit("broadcast"))
    )
    return count_by_segment("merge").unionByName(count_by_segment("shuffle_hash")).unionByName(small)


@query(
    "relational_division",
    oracle="""
    WITH wanted AS (SELECT 'all' AS divisor, o_orderpriority FROM orders
                    UNION SELECT 'unknown status', o_orderpriority FROM orders WHERE o_orderstatus = 'X')
    SELECT 'counted' AS form, 'all' AS divisor, o_custkey FROM orders GROUP BY o_custkey
    HAVING COUNT(DISTINCT o_orderpriority) = (SELECT COUNT(DISTINCT o_orderpriority) FROM orders)
    UNION ALL
    SELECT 'not exists', d.divisor, o_custkey FROM (SELECT DISTINCT o_custkey FROM orders) c,
      (VALUES ('all'), ('unknown status')) d(divisor)
    WHERE NOT EXISTS (SELECT 1 FROM wanted w WHERE w.divisor = d.divisor AND w.o_orderpriority NOT IN
      (SELECT o.o_orderpriority FROM orders o WHERE o.o_custkey = c.o_custkey))
    """,
)
def relational_division(t):
    """Customers with orders of every priority, counted and in the form NOT EXISTS; in that
    form all customers have every priority of a status that no order has."""
    found = []
    for form, divisor in (("counted", "all"), ("not exists", "all"), ("not exists", "unknown status")):
        wanted = t.orders if divisor == "all" else t.orders.where(F.col("o_orderstatus") == "X")
        keys = J.divide(t.orders, "o_custkey", "o_orderpriority", wanted, all_if_empty=form == "not exists")
        found.append(keys.select(F.lit(form).alias("form"), F.lit(divisor).alias("divisor"), "o_custkey"))
    return reduce(DataFrame.unionByName, found)


@query(
    "update_style_join",
    oracle="""
    SELECT c_custkey, COALESCE(best, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN
      (SELECT o_custkey, MAX(o_orderpriority) AS best FROM orders WHERE o_totalprice > 400000 GROUP BY o_custkey)
      ON o_custkey = c_custkey
    """,
)
def update_style_join(t):
    changes = (
        t.orders.where(F.col("o_totalprice") > 400000)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_orderpriority").alias("c_mktsegment"))
    )
    return J.overlay_values(t.customer.select("c_custkey", "c_mktsegment"), changes, ["c_custkey"], ["c_mktsegment"])

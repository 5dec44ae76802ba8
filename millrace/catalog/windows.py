"""Window functions."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.catalog.common import (
    ORDER_VALUES_SQL,
    SUPPLIER_MONTHS_SQL,
    TRANSACTIONS_SQL,
    big,
    day,
    money,
    order_values,
    real,
    supplier_months,
    transactions,
)
from millrace.operators import windows as V
from millrace.plans import ordered as O
from millrace.registry import query

KEY, ORDER = ["actid"], ["tranid"]


def _reals(df, *columns):
    return df.withColumns({x: real(x) for x in columns})


@query(
    "win_pct_total",
    oracle=f"""
    SELECT o_orderkey, CAST(val AS DOUBLE) / CAST(SUM(val) OVER () AS DOUBLE) AS of_all,
           CAST(val AS DOUBLE) / CAST(SUM(val) OVER (PARTITION BY o_custkey) AS DOUBLE) AS of_cust
    FROM ({ORDER_VALUES_SQL}) WHERE o_orderstatus <> 'P'
    """,
)
def win_pct_total(t):
    """The filter comes first, so totals cover the filtered rows only."""
    rows = order_values(t).where(F.col("o_orderstatus") != "P").select("o_orderkey", "o_custkey", "val")
    grand = rows.agg(real(F.sum("val"))).scalar()
    rows = O.with_group_totals(rows, ["o_custkey"], cust=F.sum("val"))
    return rows.select("o_orderkey", (real("val") / grand).alias("of_all"), (real("val") / real("cust")).alias("of_cust"))


@query(
    "win_over_grouped",
    oracle=f"""
    SELECT o_custkey, CAST(SUM(val) AS DOUBLE) AS total, CAST(SUM(val) AS DOUBLE) / CAST(SUM(SUM(val)) OVER () AS DOUBLE) AS share
    FROM ({ORDER_VALUES_SQL}) GROUP BY o_custkey
    """,
)
def win_over_grouped(t):
    sums = order_values(t).groupBy("o_custkey").agg(F.sum("val").alias("s"))
    grand = order_values(t).agg(real(F.sum("val"))).scalar()
    return sums.select("o_custkey", real("s").alias("total"), (real("s") / grand).alias("share"))


@query(
    "win_max_filter",
    oracle=f"""
    SELECT actid, tranid, CAST(val AS DOUBLE) AS val FROM
      (SELECT *, MAX(val) OVER (PARTITION BY actid) AS mx FROM ({TRANSACTIONS_SQL})) WHERE val = mx
    """,
)
def win_max_filter(t):
    rows = O.with_group_totals(transactions(t), KEY, mx=F.max("val"))
    return rows.where(F.col("val") == F.col("mx")).select("actid", "tranid", real("val").alias("val"))


@query(
    "running_total_rows",
    oracle=f"""
    SELECT actid, tranid, CAST(val AS DOUBLE) AS val,
           CAST(SUM(val) OVER (PARTITION BY actid ORDER BY tranid ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance
    FROM ({TRANSACTIONS_SQL})
    """,
)
def running_total_rows(t):
    return _reals(O.running(transactions(t), KEY, ORDER, balance=("sum", F.col("val"))), "val", "balance")


@query(
    "running_total_range",
    oracle="""
    SELECT event_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS DOUBLE) AS upto_day
    FROM events
    """,
)
def running_total_range(t):
    rows = t.events.select("event_id", "user_id", F.to_date("ts").alias("d"), money("value").alias("val"))
    out = V.running_with_ties(rows, ["user_id"], "d", "upto_day", "val")
    return out.select("event_id", real("upto_day").alias("upto_day"))


def _months(df, *columns):
    return df.select("empid", day("ordmonth").alias("ordmonth"), *columns)


def _by_month(low, high=0):
    """Frames over supplier months: a key has at most one row per calendar month."""
    return W.partitionBy("empid").orderBy("ordmonth").rowsBetween(low, high)


@query(
    "moving_avg_rows",
    oracle=f"""
    SELECT actid, tranid, CAST(SUM(val) OVER w AS DOUBLE) / COUNT(val) OVER w AS avg3,
           CAST(SUM(val) OVER w100 AS DOUBLE) / COUNT(val) OVER w100 AS avg100
    FROM (SELECT actid, tranid, CASE WHEN tranid % 8 >= 4 THEN val END AS val FROM ({TRANSACTIONS_SQL}))
    WINDOW w AS (PARTITION BY actid ORDER BY tranid ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
           w100 AS (PARTITION BY actid ORDER BY tranid ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
    """,
)
def moving_avg_rows(t):
    """Moving sums divided by the number of known values in the frame; half of them
    are not known."""
    gappy = transactions(t).withColumn("val", F.when(F.col("tranid") % 8 >= 4, F.col("val")))
    known = F.when(F.col("val").isNotNull(), F.lit(1))
    rows = O.moving_sums(
        gappy, KEY, ORDER,
        s3=(-2, 0, F.col("val")), n3=(-2, 0, known), s100=(-99, 0, F.col("val")), n100=(-99, 0, known),
    )
    average = lambda width: real(f"s{width}") / F.col(f"n{width}")
    return rows.select("actid", "tranid", average(3).alias("avg3"), average(100).alias("avg100"))


@query(
    "moving_max_rows",
    oracle=f"""
    SELECT actid, tranid, CAST(MAX(val) OVER (PARTITION BY actid ORDER BY tranid ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS DOUBLE) AS mx
    FROM ({TRANSACTIONS_SQL})
    """,
)
def moving_max_rows(t):
    rows = O.row_frames(transactions(t), KEY, ORDER, mx=(-99, 0, F.max("val")))
    return rows.select("actid", "tranid", real("mx").alias("mx"))


@query(
    "offset_frame",
    oracle=f"""
    SELECT actid, tranid,
           CAST(SUM(val) OVER (PARTITION BY actid ORDER BY tranid ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING) AS DOUBLE) AS s,
           CAST(MAX(val) OVER (PARTITION BY actid ORDER BY tranid ROWS BETWEEN 100 PRECEDING AND 2 PRECEDING) AS DOUBLE) AS mx
    FROM ({TRANSACTIONS_SQL})
    """,
)
def offset_frame(t):
    frames = {"s": (-5, -2, F.sum("val")), "mx": (-100, -2, F.max("val"))}
    rows = O.row_frames(transactions(t), KEY, ORDER, **frames)
    return rows.select("actid", "tranid", real("s").alias("s"), real("mx").alias("mx"))


@query(
    "single_row_frame",
    oracle=f"""
    SELECT actid, tranid, CAST(lag(val, 20) OVER (PARTITION BY actid ORDER BY tranid) AS DOUBLE) AS val20
    FROM ({TRANSACTIONS_SQL})
    """,
)
def single_row_frame(t):
    rows = O.row_frames(transactions(t), KEY, ORDER, val20=(-20, -20, F.max("val")))
    return rows.select("actid", "tranid", real("val20").alias("val20"))


@query(
    "range_interval_frame",
    oracle=f"""
    SELECT empid, strftime(ordmonth, '%Y-%m-%d') AS ordmonth, CAST(SUM(qty) OVER (PARTITION BY empid ORDER BY ordmonth
      RANGE BETWEEN INTERVAL 2 MONTH PRECEDING AND CURRENT ROW) AS DOUBLE) AS qty3
    FROM ({SUPPLIER_MONTHS_SQL})
    """,
)
def range_interval_frame(t):
    return t.sql(
        """
        SELECT empid, cast(ordmonth AS string) AS ordmonth, cast(sum(qty) OVER (PARTITION BY empid ORDER BY ordmonth
          RANGE BETWEEN INTERVAL '2' MONTH PRECEDING AND CURRENT ROW) AS double) AS qty3
        FROM {months}
        """,
        months=supplier_months(t),
    )


@query(
    "padded_calendar_window",
    oracle=f"""
    WITH e AS ({SUPPLIER_MONTHS_SQL}),
    g AS (SELECT empid, CAST(m AS DATE) AS ordmonth FROM (SELECT DISTINCT empid FROM e),
          (SELECT unnest(generate_series(CAST((SELECT MIN(ordmonth) FROM e) AS TIMESTAMP),
                                         CAST((SELECT MAX(ordmonth) FROM e) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m))
    SELECT empid, strftime(ordmonth, '%Y-%m-%d') AS ordmonth, CAST(qty3 AS DOUBLE) AS qty3 FROM
      (SELECT g.empid, g.ordmonth, e.qty, SUM(e.qty) OVER (PARTITION BY g.empid ORDER BY g.ordmonth
         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS qty3
       FROM g LEFT JOIN e ON e.empid = g.empid AND e.ordmonth = g.ordmonth) WHERE qty IS NOT NULL
    """,
)
def padded_calendar_window(t):
    padded = V.padded_months(supplier_months(t), "empid", "ordmonth")
    framed = padded.withColumn("qty3", F.sum("qty").over(_by_month(-2)))
    return _months(framed.where(F.col("qty").isNotNull()), real("qty3").alias("qty3"))


@query(
    "ytd_total",
    oracle=f"""
    SELECT empid, strftime(ordmonth, '%Y-%m-%d') AS ordmonth,
           CAST(SUM(qty) OVER (PARTITION BY empid, year(ordmonth) ORDER BY ordmonth) AS DOUBLE) AS ytd
    FROM ({SUPPLIER_MONTHS_SQL})
    """,
)
def ytd_total(t):
    w = W.partitionBy("empid", F.year("ordmonth")).orderBy("ordmonth")
    return _months(supplier_months(t).withColumn("ytd", F.sum("qty").over(w)), real("ytd").alias("ytd"))


@query(
    "ytd_over_grouped",
    oracle="""
    SELECT l_suppkey, strftime(d, '%Y-%m-%d') AS d, CAST(SUM(SUM(q)) OVER (PARTITION BY l_suppkey, year(d) ORDER BY d) AS DOUBLE) AS ytd
    FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem)
    GROUP BY l_suppkey, d
    """,
)
def ytd_over_grouped(t):
    days = t.lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("d")).agg(F.sum(money("l_quantity")).alias("q"))
    w = W.partitionBy("l_suppkey", F.year("d")).orderBy("d")
    return days.select("l_suppkey", day("d").alias("d"), real(F.sum("q").over(w)).alias("ytd"))


@query(
    "row_number",
    oracle=f"""
    SELECT actid, tranid, row_number() OVER (PARTITION BY actid ORDER BY tranid) AS rn,
           row_number() OVER (PARTITION BY actid ORDER BY val DESC, tranid DESC) AS rn_desc
    FROM ({TRANSACTIONS_SQL})
    """,
)
def row_number(t):
    rows = O.number_rows(transactions(t), KEY, ORDER)
    rows = rows.withColumns({"_v": -F.col("val"), "_t": -F.col("tranid")})
    return O.number_rows(rows, KEY, ["_v", "_t"], "rn_desc").select("actid", "tranid", "rn", "rn_desc")


@query("row_number_arbitrary", oracle="SELECT row_number() OVER () AS rn FROM events")
def row_number_arbitrary(t):
    """Any order is right; only the numbers are compared."""
    return O.number_rows(t.events.select("event_id"), [], ["event_id"]).select("rn")


@query(
    "rank_dense_rank",
    oracle="""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line, l_quantity,
           rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS rnk,
           dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS drnk
    FROM lineitem
    """,
)
def rank_dense_rank(t):
    rows = t.lineitem.select("l_suppkey", "l_orderkey", big("l_linenumber").alias("line"), "l_quantity")
    ranked = O.with_ranks(rows, ["l_suppkey"], ["l_quantity"], rank="rnk", dense_rank="drnk")
    return ranked.select("l_orderkey", "line", "l_quantity", "rnk", "drnk")


@query(
    "ntile",
    oracle=f"""
    SELECT actid, tranid, ntile(4) OVER (PARTITION BY actid ORDER BY val, tranid) AS quarter,
           ntile(100) OVER (PARTITION BY actid ORDER BY val, tranid) AS pct
    FROM ({TRANSACTIONS_SQL})
    """,
)
def ntile(t):
    tiles = V.with_ntile(transactions(t), KEY, ["val", "tranid"], quarter=4, pct=100)
    return tiles.select("actid", "tranid", "quarter", "pct")


@query(
    "row_number_two_directions",
    oracle=f"""
    SELECT actid, tranid, row_number() OVER (PARTITION BY actid ORDER BY tranid) AS up,
           row_number() OVER (PARTITION BY actid ORDER BY tranid DESC) AS down
    FROM ({TRANSACTIONS_SQL})
    """,
)
def row_number_two_directions(t):
    """The descending number is the group size minus the ascending one plus 1, so
    one sort serves both."""
    rows = O.number_rows(transactions(t), KEY, ORDER, "up")
    rows = O.with_group_totals(rows, KEY, n=F.count(F.lit(1)))
    return rows.select("actid", "tranid", "up", (F.col("n") - F.col("up") + 1).alias("down"))


@query(
    "first_last_value",
    oracle=f"""
    SELECT o_orderkey, CAST(first_value(val) OVER (PARTITION BY o_custkey ORDER BY odate, o_orderkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS first_val,
           CAST(last_value(val) OVER (PARTITION BY o_custkey ORDER BY odate, o_orderkey
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS last_val
    FROM ({ORDER_VALUES_SQL})
    """,
)
def first_last_value(t):
    rows = V.with_first_last(order_values(t), ["o_custkey"], ["odate", "o_orderkey"], "val", "first_val", "last_val")
    return _reals(rows.select("o_orderkey", "first_val", "last_val"), "first_val", "last_val")


@query(
    "lag_lead",
    oracle=f"""
    SELECT o_orderkey, CAST(lag(val) OVER w AS DOUBLE) AS prev_val, CAST(lead(val, 1, 0) OVER w AS DOUBLE) AS next_val
    FROM ({ORDER_VALUES_SQL}) WINDOW w AS (PARTITION BY o_custkey ORDER BY odate, o_orderkey)
    """,
)
def lag_lead(t):
    rows = O.neighbours(
        order_values(t), ["o_custkey"], ["odate", "o_orderkey"],
        previous={"prev_val": "val"}, following={"next_val": "val", "next_key": "o_orderkey"},
    )
    following = F.when(F.col("next_key").isNull(), F.lit(0)).otherwise(F.col("next_val"))
    return rows.select("o_orderkey", real("prev_val").alias("prev_val"), real(following).alias("next_val"))


@query(
    "percent_rank_cume_dist",
    oracle="""
    SELECT p_partkey, percent_rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice) AS prnk,
           cume_dist() OVER (PARTITION BY p_brand ORDER BY p_retailprice) AS cdist
    FROM part
    """,
)
def percent_rank_cume_dist(t):
    rows = t.part.select("p_partkey", "p_brand", "p_retailprice")
    ranked = O.with_ranks(rows, ["p_brand"], ["p_retailprice"], percent_rank="prnk", cume_dist="cdist")
    return ranked.select("p_partkey", "prnk", "cdist")


def _medians(t):
    return O.group_percentiles(
        t.part.select("p_brand", "p_retailprice"), ["p_brand"], "p_retailprice", disc=("disc", 0.5), cont=("cont", 0.5)
    )


MEDIANS = """
SELECT p_brand, round(percentile_disc(0.5) WITHIN GROUP (ORDER BY p_retailprice), 4) AS disc,
       round(percentile_cont(0.5) WITHIN GROUP (ORDER BY p_retailprice), 4) AS cont
FROM part GROUP BY p_brand
"""


@query("percentile_window", oracle=f"SELECT p_partkey, disc, cont FROM part JOIN ({MEDIANS}) m ON m.p_brand = part.p_brand")
def percentile_window(t):
    joined = t.part.select("p_partkey", "p_brand").join(_medians(t), "p_brand")
    return joined.select("p_partkey", F.round("disc", 4).alias("disc"), F.round("cont", 4).alias("cont"))


@query("percentile_group", oracle=MEDIANS)
def percentile_group(t):
    return _medians(t).select("p_brand", F.round("disc", 4).alias("disc"), F.round("cont", 4).alias("cont"))


@query(
    "partition_count",
    oracle="""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line, l_partkey,
           COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies
    FROM lineitem
    """,
)
def partition_count(t):
    rows = O.with_group_totals(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"], copies=F.count(F.lit(1))
    )
    return rows.select("l_orderkey", big("l_linenumber").alias("line"), "l_partkey", "copies")

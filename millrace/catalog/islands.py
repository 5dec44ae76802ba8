"""Gaps, islands, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import SUPPLIER_MONTHS_SQL, day, second, supplier_months
from millrace.operators import islands as I
from millrace.registry import query

KEYS = "SELECT DISTINCT l_orderkey AS k FROM lineitem"


@query(
    "gaps",
    oracle=f"""
    SELECT k + 1 AS range_from, nxt - 1 AS range_to FROM (SELECT k, lead(k) OVER (ORDER BY k) AS nxt FROM ({KEYS})) WHERE nxt - k > 1
    """,
)
def gaps(t):
    return I.gaps(t.lineitem, "l_orderkey")


@query(
    "min_missing",
    oracle=f"""
    SELECT CASE WHEN NOT EXISTS (SELECT 1 FROM ({KEYS}) WHERE k = 1) THEN 1 ELSE
      (SELECT MIN(a.k) + 1 FROM ({KEYS}) a WHERE a.k >= 1 AND NOT EXISTS (SELECT 1 FROM ({KEYS}) b WHERE b.k = a.k + 1)) END AS missing
    """,
)
def min_missing(t):
    return I.min_missing(t.lineitem, "l_orderkey")


@query(
    "islands",
    oracle=f"""
    SELECT MIN(k) AS start_range, MAX(k) AS end_range FROM (SELECT k, k - row_number() OVER (ORDER BY k) AS g FROM ({KEYS})) GROUP BY g
    """,
)
def islands(t):
    return I.islands(t.lineitem, "l_orderkey").drop("n_rows")


@query(
    "islands_dupes",
    oracle="""
    SELECT MIN(k) AS start_range, MAX(k) AS end_range, COUNT(*) AS n_rows FROM
      (SELECT l_orderkey AS k, l_orderkey - dense_rank() OVER (ORDER BY l_orderkey) AS g FROM lineitem) GROUP BY g
    """,
)
def islands_dupes(t):
    return I.islands(t.lineitem, "l_orderkey")


@query(
    "date_islands",
    oracle="""
    SELECT l_suppkey, strftime(MIN(d), '%Y-%m-%d') AS start_date, strftime(MAX(d), '%Y-%m-%d') AS end_date, COUNT(*) AS n_rows FROM
      (SELECT l_suppkey, d, d - CAST(dense_rank() OVER (PARTITION BY l_suppkey ORDER BY d) AS INTEGER) AS g
       FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d FROM lineitem))
    GROUP BY l_suppkey, g
    """,
)
def date_islands(t):
    found = I.date_islands(t.lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("d")), "l_suppkey", "d")
    return found.select("l_suppkey", day("start_date").alias("start_date"), day("end_date").alias("end_date"), "n_rows")


@query(
    "islands_with_tolerance",
    oracle="""
    SELECT user_id, session, strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS session_start,
           strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS session_end, COUNT(*) AS n_rows FROM
      (SELECT user_id, ts, CAST(SUM(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session FROM
        (SELECT user_id, ts, event_id, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 12 HOUR
                                            THEN 0 ELSE 1 END AS s FROM events))
    GROUP BY user_id, session
    """,
)
def islands_with_tolerance(t):
    found = I.sessions(t.events, ["user_id"], "ts", "event_id", F.expr("interval 12 hours"))
    return found.select(
        "user_id", "session", second("session_start").alias("session_start"), second("session_end").alias("session_end"), "n_rows"
    )


@query(
    "islands_by_value",
    oracle=f"""
    WITH m AS (SELECT empid, (year(ordmonth) - 1995) * 12 + month(ordmonth) AS num,
                      CASE WHEN qty > 200 THEN 'high' ELSE 'low' END AS label FROM ({SUPPLIER_MONTHS_SQL})),
    r AS (SELECT empid, label, MIN(num) AS a, MAX(num) AS b FROM
           (SELECT *, num - row_number() OVER (PARTITION BY empid, label ORDER BY num) AS g FROM m) GROUP BY empid, label, g)
    SELECT empid, string_agg(CASE WHEN a < b THEN a || ' - ' || b ELSE CAST(a AS VARCHAR) END || ' ' || label, ', ' ORDER BY a) AS ranges
    FROM r GROUP BY empid
    """,
)
def islands_by_value(t):
    num = (F.year("ordmonth") - 1995) * 12 + F.month("ordmonth")
    label = F.when(F.col("qty") > 200, "high").otherwise("low")
    return I.label_ranges(supplier_months(t).select("empid", num.alias("num"), label.alias("label")), "empid", "num", "label")

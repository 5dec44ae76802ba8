"""Monitoring reports over the event table."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.catalog.common import big, money, real, second, text
from millrace.operators import monitoring as B
from millrace.operators import quality as Q
from millrace.registry import query

HOURLY = """
SELECT event_type, h, SUM(SUM(CAST(value AS DECIMAL(18,2)))) OVER w AS total, CAST(SUM(COUNT(*)) OVER w AS BIGINT) AS n
FROM (SELECT event_type, date_trunc('hour', ts) AS h, value FROM events) GROUP BY event_type, h
WINDOW w AS (PARTITION BY event_type ORDER BY h)
"""


def hourly_counters(t):
    """Running total and count per event type at the end of every hour."""
    hours = t.events.groupBy("event_type", F.date_trunc("hour", "ts").alias("h")).agg(
        F.sum(money("value")).alias("s"), F.count(F.lit(1)).alias("c")
    )
    w = W.partitionBy("event_type").orderBy("h").rowsBetween(W.unboundedPreceding, 0)
    return hours.select("event_type", "h", F.sum("s").over(w).alias("total"), F.sum("c").over(w).alias("n"))


@query(
    "counter_deltas",
    oracle=f"""
    SELECT event_type, strftime(h, '%Y-%m-%d %H:%M:%S') AS ended, date_diff('second', p, h) AS seconds,
           CAST(total - pt AS DOUBLE) AS d_total, n - pn AS d_n, CASE WHEN n - pn = 0 THEN 0 ELSE CAST(total - pt AS DOUBLE) / (n - pn) END AS mean
    FROM (SELECT *, lag(h) OVER w AS p, lag(total) OVER w AS pt, lag(n) OVER w AS pn FROM ({HOURLY}) WINDOW w AS (PARTITION BY event_type ORDER BY h))
    WHERE p IS NOT NULL AND event_type NOT IN ('error') ORDER BY total - pt DESC, event_type, h LIMIT 10
    """,
)
def counter_deltas(t):
    """The ten largest hourly increases, errors excluded."""
    snapshots = hourly_counters(t).where(~F.col("event_type").isin("error"))
    deltas = B.counter_deltas(snapshots, "event_type", "h", ["total", "n"])
    top = deltas.orderBy(F.desc("d_total"), "event_type", "h").limit(10)
    return top.select(
        "event_type",
        second("h").alias("ended"),
        "seconds",
        real("d_total").alias("d_total"),
        "d_n",
        B.safe_ratio(F.col("d_total"), F.col("d_n")).alias("mean"),
    )


@query(
    "share_of_total",
    oracle="""
    WITH u AS (SELECT user_id, COUNT(*) AS n, SUM(CAST(value AS DECIMAL(18,2))) AS v, SUM(CASE WHEN event_type = 'none' THEN 1 ELSE 0 END) AS z,
                      date_diff('minute', MIN(ts), MAX(ts)) AS m FROM events GROUP BY user_id)
    SELECT user_id, 100.0 * CAST(v AS DOUBLE) / CAST(SUM(v) OVER () AS DOUBLE) AS pct_value,
           100.0 * CAST(n AS DOUBLE) / CAST(SUM(n) OVER () AS DOUBLE) AS pct_events, CAST(0 AS DOUBLE) AS pct_none,
           CASE WHEN m = 0 THEN 0 ELSE CAST(n AS DOUBLE) / m END AS per_minute FROM u
    """,
)
def share_of_total(t):
    """Percent of each total (0 if the total is 0) and events per minute."""
    measures = [
        F.count(F.lit(1)).alias("n"),
        F.sum(money("value")).alias("v"),
        F.count_if(F.col("event_type") == "none").alias("z"),
    ]
    whole = t.events.agg(F.struct(*measures)).scalar()
    users = t.events.groupBy("user_id").agg(*measures, F.min("ts").alias("a"), F.max("ts").alias("b"))
    # minute boundaries crossed
    minute = lambda x: F.unix_timestamp(F.date_trunc("minute", x).cast("timestamp")) / 60
    minutes = big(minute("b") - minute("a"))
    pct = lambda x: F.lit(100.0) * B.safe_ratio(F.col(x), whole[x])
    exact = lambda x: B.safe_ratio(F.lit(100.0) * real(x), whole[x])
    return users.select(
        "user_id",
        exact("v").alias("pct_value"),
        exact("n").alias("pct_events"),
        pct("z").alias("pct_none"),
        B.safe_ratio(F.col("n"), minutes).alias("per_minute"),
    )


@query(
    "top_waits",
    oracle="""
    WITH u AS (SELECT user_id, COUNT(*) AS n, SUM(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY user_id)
    SELECT rn || ' - user ' || user_id AS finding, v_d AS total, 100.0 * v_d / all_d AS pct, v_d / n AS mean FROM
      (SELECT user_id, n, CAST(v AS DOUBLE) AS v_d, CAST(SUM(v) OVER () AS DOUBLE) AS all_d, row_number() OVER (ORDER BY v DESC, user_id) AS rn FROM u)
    WHERE rn <= 9
    """,
)
def top_waits(t):
    sums = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("v"))
    whole = t.events.agg(real(F.sum(money("value")))).scalar()
    top = sums.orderBy(F.desc("v"), "user_id").limit(9)
    rn = F.row_number().over(W.orderBy(F.desc("v"), "user_id"))  # over the nine rows left
    return top.select(
        F.concat(text(rn), F.lit(" - user "), text("user_id")).alias("finding"),
        real("v").alias("total"),
        (F.lit(100.0) * real("v") / whole).alias("pct"),
        (real("v") / F.col("n")).alias("mean"),
    )


@query(
    "best_row_per_handle",
    oracle="""
    SELECT user_id, event_id, event_type, value FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def best_row_per_handle(t):
    rows = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    allowed = {"amount": "value", "latest": "ts"}
    return B.best_row(rows, "user_id", allowed, "amount", "event_id").select("user_id", "event_id", "event_type", "value")


@query(
    "event_shred_report",
    oracle="""
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at_time, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value
    FROM events WHERE event_type IN ('error', 'purchase') ORDER BY ts, event_id
    """,
)
def event_shred_report(t):
    kept = t.events.where(F.col("event_type").isin("error", "purchase")).orderBy("ts", "event_id")
    return kept.select(
        "event_id", second("ts").alias("at_time"), "user_id", big(F.get_json_object("props", "$.k")).alias("k"), "value"
    )


@query(
    "findings_report",
    oracle="""
    SELECT CAST(10 AS BIGINT) AS priority, 'duplicate line' AS finding, l_orderkey || '/' || l_linenumber AS detail
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
    UNION ALL
    SELECT 20, 'order without lines', CAST(o_orderkey AS VARCHAR) FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    UNION ALL
    SELECT 30, 'negative balance', c_name FROM customer WHERE c_acctbal < 0
    """,
)
def findings_report(t):
    duplicates = Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
    empty = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    poor = Q.check_violations(t.customer, F.col("c_acctbal") >= 0)
    return B.findings(
        [
            (10, "duplicate line", duplicates, F.concat_ws("/", "l_orderkey", "l_linenumber")),
            (20, "order without lines", empty, text("o_orderkey")),
            (30, "negative balance", poor, F.col("c_name")),
        ]
    )

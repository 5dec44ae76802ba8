"""Streaming counterparts, run over the stored tables as file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.changes import FINISHED, LARGE, LOW, VERSION, stored
from millrace.catalog.common import big, money, real, second
from millrace.registry import query
from millrace.streaming import streams as R


def event_stream(t):
    rows = R.read_stream(t.spark, t.path("events"), t.events.schema)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "stream_change_log",
    oracle=f"""
    SELECT o_orderkey, 'o_orderstatus' AS "column", o_orderstatus AS old_value, 'N' AS new_value FROM orders WHERE {FINISHED} AND NOT {LOW}
    UNION ALL
    SELECT o_orderkey, 'version', CAST({VERSION} AS VARCHAR), CAST({VERSION} - 1 AS VARCHAR) FROM orders WHERE {FINISHED} AND NOT {LOW} AND {LARGE}
    UNION ALL
    SELECT o_orderkey, 'o_orderstatus', 'N', 'S' FROM orders WHERE {FINISHED} AND NOT {LOW} AND {LARGE}
    """,
)
def stream_change_log(t):
    """Finished orders change; large ones change a second time in the same batch."""
    arriving = R.read_stream(t.spark, t.path("orders"), t.orders.schema).where(F.expr(FINISHED))
    stale = F.when(F.expr(LARGE), 1).otherwise(0)
    status = F.when(F.expr(LARGE), F.array(F.lit("N"), F.lit("S"))).otherwise(F.array(F.lit("N")))
    changes = arriving.select(
        "o_orderkey", F.posexplode(status).alias("step", "o_orderstatus"), (big(F.year("o_orderdate")) - stale).alias("version")
    )
    log = R.stream_change_log(changes, stored(t), ["o_orderkey"], ["o_orderstatus", "version"], ["step"])
    return log.select("o_orderkey", "column", "old_value", "new_value")


@query(
    "stream_sessions",
    oracle="""
    SELECT user_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS session_start, strftime(b, '%Y-%m-%d %H:%M:%S') AS session_end, n_rows FROM
      (SELECT user_id, session, MIN(ts) AS a, MAX(ts) AS b, COUNT(*) AS n_rows FROM
        (SELECT user_id, ts, SUM(s) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM
          (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR THEN 0 ELSE 1 END AS s FROM events))
       GROUP BY user_id, session)
    WHERE b + INTERVAL 12 HOUR <= (SELECT MAX(ts) - INTERVAL 1 HOUR FROM events)
    """,
)
def stream_sessions(t):
    found = R.stream_sessions(event_stream(t), "user_id", "ts", "12 hours", "1 hour")
    return found.select(
        "user_id", second("session_start").alias("session_start"), second("session_end").alias("session_end"), "n_rows"
    )


@query(
    "stream_counter_windows",
    oracle="""
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS started, event_type, COUNT(*) AS n,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY date_trunc('hour', ts), event_type
    """,
)
def stream_counter_windows(t):
    rows = event_stream(t).withColumn("amount", money("value"))
    found = R.stream_counter_windows(rows, "event_type", "ts", "1 hour", "1 hour", "amount")
    return found.select(second("started").alias("started"), "event_type", "n", real("total").alias("total"))

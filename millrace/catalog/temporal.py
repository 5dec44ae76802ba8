"""System-time tables. Every event of a user is a version of that user's row; an
error event deletes the row."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import big, second
from millrace.operators import temporal as V
from millrace.registry import query
from millrace.sources.tables import materialise

T1, T2 = "2024-01-10 00:00:00", "2024-01-20 12:00:00"


def user_versions(t):
    """The versions as a stored table, whose period columns filters can reach."""
    rows = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    return materialise(V.versions(rows, ["user_id"], "ts", "event_id").where(F.col("event_type") != "error"), "versions")


USERS = """
SELECT * FROM (SELECT user_id, event_id, event_type, value, ts AS valid_from,
  COALESCE(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '9999-12-31') AS valid_to FROM events)
WHERE event_type <> 'error'
"""
PERIOD = "strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to"


def _shown(df, *more):
    return df.select(
        "user_id", "event_id", "event_type", "value", second("valid_from").alias("valid_from"), second("valid_to").alias("valid_to"), *more
    )


def _sql(condition):
    return f"SELECT user_id, event_id, event_type, value, {PERIOD} FROM ({USERS}) WHERE {condition}"


NOW = "valid_to = TIMESTAMP '9999-12-31'"


@query("temporal_current", oracle=_sql(NOW))
def temporal_current(t):
    return _shown(V.current(user_versions(t)))


@query(
    "temporal_all",
    oracle=f"SELECT user_id, event_id, event_type, value, {PERIOD}, CAST(CASE WHEN {NOW} THEN 1 ELSE 0 END AS BIGINT) AS is_current FROM ({USERS})",
)
def temporal_all(t):
    v = user_versions(t)
    return _shown(V.all_versions(V.current(v), V.history(v)), "is_current")


@query("temporal_as_of", oracle=_sql(f"valid_from <= TIMESTAMP '{T1}' AND valid_to > TIMESTAMP '{T1}'"))
def temporal_as_of(t):
    return _shown(V.as_of(user_versions(t), V.moment(T1)))


@query("temporal_from_to", oracle=_sql(f"valid_from < TIMESTAMP '{T2}' AND valid_to > TIMESTAMP '{T1}'"))
def temporal_from_to(t):
    return _shown(V.from_to(user_versions(t), V.moment(T1), V.moment(T2)))


@query("temporal_between", oracle=_sql(f"valid_from <= TIMESTAMP '{T2}' AND valid_to > TIMESTAMP '{T1}'"))
def temporal_between(t):
    return _shown(V.between(user_versions(t), V.moment(T1), V.moment(T2)))


@query("temporal_contained_in", oracle=_sql(f"valid_from >= TIMESTAMP '{T1}' AND valid_to <= TIMESTAMP '{T2}'"))
def temporal_contained_in(t):
    return _shown(V.contained_in(user_versions(t), V.moment(T1), V.moment(T2)))


def type_versions(t):
    """Versions of the latest value per event type."""
    rows = t.events.select("event_type", F.col("event_id").alias("type_event"), F.col("value").alias("type_value"), "ts")
    return materialise(V.versions(rows, ["event_type"], "ts", "type_event"), "versions")


TYPES = """
SELECT event_type, event_id AS type_event, value AS type_value, ts AS valid_from,
  COALESCE(lead(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id), TIMESTAMP '9999-12-31') AS valid_to FROM events
"""


def _at(sql, t):
    return f"(SELECT * FROM ({sql}) WHERE valid_from <= TIMESTAMP '{t}' AND valid_to > TIMESTAMP '{t}')"


@query(
    "temporal_join_as_of",
    oracle=f"""
    SELECT u.user_id, u.event_id, u.event_type, u.value, k.type_event, k.type_value
    FROM {_at(USERS, T2)} u JOIN {_at(TYPES, T2)} k ON k.event_type = u.event_type
    """,
)
def temporal_join_as_of(t):
    return V.join_as_of(user_versions(t), type_versions(t), ["event_type"], V.moment(T2))


STATE = "SELECT user_id, event_type, value FROM"


@query(
    "temporal_diff",
    oracle=f"""
    WITH o AS ({STATE} {_at(USERS, T1)}), n AS ({STATE} ({USERS}) WHERE {NOW})
    SELECT *, 'new' AS side FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o)
    UNION ALL SELECT *, 'old' FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n)
    """,
)
def temporal_diff(t):
    return V.diff(user_versions(t), V.moment(T1), ["user_id", "event_type", "value"])


@query(
    "temporal_recover_deleted",
    oracle=f"""
    SELECT user_id, event_id, event_type, value, {PERIOD} FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY valid_to DESC) AS rn FROM ({USERS}))
    WHERE rn = 1 AND NOT {NOW}
    """,
)
def temporal_recover_deleted(t):
    return _shown(V.deleted_rows(user_versions(t), ["user_id"]))


@query(
    "temporal_write",
    oracle=f"""
    WITH v AS ({USERS}), c AS (SELECT * FROM v WHERE {NOW})
    SELECT user_id, event_id, event_type, value, {PERIOD} FROM (
      SELECT * FROM v WHERE NOT {NOW}
      UNION ALL
      SELECT user_id, event_id, event_type, value, valid_from, CASE WHEN event_type IN ('click', 'view') THEN TIMESTAMP '2024-02-01' ELSE valid_to END FROM c
      UNION ALL
      SELECT user_id, event_id, 'visit', value + 1, TIMESTAMP '2024-02-01', TIMESTAMP '9999-12-31' FROM c WHERE event_type = 'click'
      UNION ALL
      SELECT c_custkey + 100000, 0, 'new', c_acctbal, TIMESTAMP '2024-02-01', TIMESTAMP '9999-12-31' FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
)
def temporal_write(t):
    """Users last seen clicking are updated, those last seen viewing deleted, and
    customers of one segment inserted."""
    table = user_versions(t).select("user_id", "event_id", "event_type", "value", "valid_from", "valid_to")
    now = V.current(table)
    updates = now.where(F.col("event_type") == "click").select(
        "user_id", "event_id", F.lit("visit").alias("event_type"), (F.col("value") + 1).alias("value"), F.lit(False).alias("gone")
    )
    deletes = now.where(F.col("event_type") == "view").select("user_id", "event_id", "event_type", "value", F.lit(True).alias("gone"))
    inserts = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(
        (F.col("c_custkey") + 100000).alias("user_id"), big(F.lit(0)).alias("event_id"), F.lit("new").alias("event_type"),
        F.col("c_acctbal").alias("value"), F.lit(False).alias("gone"),
    )
    changes = updates.unionByName(deletes).unionByName(inserts)
    return _shown(V.write(table, changes, ["user_id"], V.moment("2024-02-01"), F.col("gone")))


@query(
    "temporal_add_column",
    oracle=f"SELECT user_id, event_id, {PERIOD}, CASE WHEN {NOW} THEN upper(event_type) END AS label FROM ({USERS})",
)
def temporal_add_column(t):
    v = user_versions(t)
    now = V.current(v).withColumn("label", F.upper("event_type"))
    rows = V.add_column(now, V.history(v))
    return rows.select("user_id", "event_id", second("valid_from").alias("valid_from"), second("valid_to").alias("valid_to"), "label")


@query(
    "temporal_enable",
    oracle="SELECT c_custkey, c_name, '2024-01-01 00:00:00' AS valid_from, '9999-12-31 00:00:00' AS valid_to FROM customer",
)
def temporal_enable(t):
    rows = V.enable(t.customer.select("c_custkey", "c_name"), V.moment("2024-01-01"))
    return rows.withColumns({"valid_from": second("valid_from"), "valid_to": second("valid_to")})

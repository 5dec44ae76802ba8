"""Set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import big
from millrace.operators import setops as U
from millrace.registry import query


def places(t):
    """Customers' and suppliers' (nation, balance band); nation 3 is NULL."""

    def pick(df, nation, balance):
        return df.select(
            big(F.nullif(nation, F.lit(3))).alias("nation"), big(F.floor(F.col(balance) / 500)).alias("band")
        )

    return pick(t.customer, "c_nationkey", "c_acctbal"), pick(t.supplier, "s_nationkey", "s_acctbal")


A = "SELECT CAST(nullif(c_nationkey, 3) AS BIGINT) AS nation, CAST(floor(c_acctbal / 500) AS BIGINT) AS band FROM customer"
B = "SELECT CAST(nullif(s_nationkey, 3) AS BIGINT) AS nation, CAST(floor(s_acctbal / 500) AS BIGINT) AS band FROM supplier"


@query("union_distinct", oracle=f"{A} UNION {B}")
def union_distinct(t):
    a, b = places(t)
    return a.union(b).distinct()


@query("union_all", oracle=f"{A} UNION ALL {B}")
def union_all(t):
    a, b = places(t)
    return a.unionByName(b)


@query("intersect", oracle=f"{A} INTERSECT {B}")
def intersect(t):
    a, b = places(t)
    return a.intersect(b)


@query("intersect_all", oracle=f"{A} INTERSECT ALL {B}")
def intersect_all(t):
    a, b = places(t)
    return a.intersectAll(b)


@query("except", oracle=f"{A} EXCEPT {B}")
def except_distinct(t):
    a, b = places(t)
    return a.subtract(b)


@query("except_all", oracle=f"{A} EXCEPT ALL {B}")
def except_all(t):
    a, b = places(t)
    return a.exceptAll(b)


OLD = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW'"
NEW = """
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
FROM orders WHERE o_orderpriority <> '1-URGENT'
"""


@query(
    "table_diff",
    oracle=f"""
    SELECT *, 'new' AS side FROM (({NEW}) EXCEPT ALL ({OLD})) UNION ALL SELECT *, 'old' FROM (({OLD}) EXCEPT ALL ({NEW}))
    """,
)
def table_diff(t):
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    old = t.orders.where(F.col("o_orderpriority") != "5-LOW").select(*columns)
    status = F.when(F.col("o_totalprice") > 400000, "X").otherwise(F.col("o_orderstatus"))
    new = t.orders.where(F.col("o_orderpriority") != "1-URGENT").withColumn("o_orderstatus", status).select(*columns)
    return U.table_diff(old, new)

"""Sort, limit, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import big, money, real
from millrace.operators import joins as J
from millrace.operators import sorting as S
from millrace.registry import query


@query(
    "order_by",
    oracle="""
    SELECT p_partkey, nullif(p_type, 'PROMO') AS kind, CAST(p_size AS BIGINT) AS p_size FROM part
    ORDER BY kind ASC NULLS FIRST, p_size DESC NULLS LAST, p_partkey
    """,
)
def order_by(t):
    rows = t.part.select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("kind"), big("p_size").alias("p_size"))
    return rows.orderBy(F.col("kind").asc_nulls_first(), F.col("p_size").desc_nulls_last(), "p_partkey")


@query(
    "top_n",
    oracle="""
    SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey LIMIT 10
    """,
)
def top_n(t):
    totals = t.orders.groupBy("o_custkey").agg(real(F.sum(money("o_totalprice"))).alias("total"))
    return totals.orderBy(F.desc("total"), "o_custkey").limit(10)


@query(
    "top_n_per_group",
    oracle="""
    SELECT p_brand, p_partkey, rn FROM
      (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part)
    WHERE rn <= 3
    """,
)
def top_n_per_group(t):
    best = J.top_n_per_group(t.part, ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")], 3)
    return best.select("p_brand", "p_partkey", "rn")


@query(
    "offset_fetch",
    oracle="SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50",
)
def offset_fetch(t):
    ordered = t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey")
    return ordered.offset(50).limit(25).select("o_orderkey", "o_custkey")


@query(
    "dynamic_sort",
    oracle="SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_nationkey, s_acctbal DESC, s_suppkey",
)
def dynamic_sort(t):
    allowed = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    return S.dynamic_sort(t.supplier, allowed, "s_nationkey", "s_acctbal desc", "s_suppkey").select(
        "s_suppkey", "s_name", "s_acctbal"
    )


@query(
    "sort_by_list_position",
    oracle="""
    SELECT p_partkey, COALESCE(CAST(l.pos AS BIGINT), CAST(p_size AS BIGINT)) AS sort_order FROM part
      LEFT JOIN (VALUES (1, 17), (2, 4), (3, 99)) AS l(pos, id) ON id = p_partkey
    """,
)
def sort_by_list_position(t):
    """Write a new sort order onto the listed rows and keep that of the others."""
    ids = J.id_list(t.spark, "17,4,99").select(F.col("id").alias("p_partkey"), F.col("pos").alias("sort_order"))
    rows = t.part.select("p_partkey", big("p_size").alias("sort_order"))
    return J.overlay_values(rows, F.broadcast(ids), ["p_partkey"], ["sort_order"]).orderBy("sort_order", "p_partkey")

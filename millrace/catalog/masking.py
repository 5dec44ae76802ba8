"""Data masking."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import day
from millrace.functions import masking as M
from millrace.registry import query


def people(t):
    email = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
    return t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", email.alias("email"))


@query(
    "mask_default",
    oracle="""
    SELECT o_orderkey, 'xxxx' AS o_orderstatus, CAST(0 AS DOUBLE) AS o_totalprice, '2000-01-01' AS odate FROM orders
    """,
)
def mask_default(t):
    o = t.orders
    return o.select(
        "o_orderkey",
        M.mask_default(o, "o_orderstatus").alias("o_orderstatus"),
        M.mask_default(o, "o_totalprice").alias("o_totalprice"),
        day(M.mask_default(o, "o_orderdate")).alias("odate"),
    )


@query("mask_email", oracle="SELECT c_custkey, left(lower(c_name), 1) || 'XXX@XXXX.com' AS email FROM customer")
def mask_email(t):
    return people(t).select("c_custkey", M.mask_email(F.col("email")).alias("email"))


@query(
    "mask_partial",
    oracle="""
    SELECT p_partkey, left(p_name, 2) || 'XXXXXXXX' || right(p_name, 1) AS name,
           CASE WHEN length(p_type) < 8 THEN 'XX' ELSE left(p_type, 4) || 'XX' || right(p_type, 4) END AS kind
    FROM part
    """,
)
def mask_partial(t):
    return t.part.select(
        "p_partkey",
        M.mask_partial(F.col("p_name"), 2, "XXXXXXXX", 1).alias("name"),
        M.mask_partial(F.col("p_type"), 4, "XX", 4).alias("kind"),
    )


@query(
    "mask_view",
    oracle="""
    SELECT 'masked' AS reader, c_custkey, left(c_name, 1) || 'XXXXX' AS c_name, CAST(0 AS DOUBLE) AS c_acctbal FROM customer WHERE c_acctbal > 5000
    UNION ALL SELECT 'clear', c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 5000
    """,
)
def mask_view(t):
    """One query for two readers; the balance filter sees clear values for both."""
    rich = people(t).where(F.col("c_acctbal") > 5000).select("c_custkey", "c_name", "c_acctbal")
    rules = {
        "c_name": M.mask_partial(F.col("c_name"), 1, "XXXXX", 0),
        "c_acctbal": M.mask_default(rich, "c_acctbal"),
    }
    hidden = M.masked(rich, False, **rules).withColumn("reader", F.lit("masked"))
    return hidden.unionByName(M.masked(rich, True, **rules).withColumn("reader", F.lit("clear")))

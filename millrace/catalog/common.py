"""Column helpers and derived inputs shared by the catalog modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import Tables


def c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def money(column: Column | str) -> Column:
    return c(column).cast("decimal(18,2)")


def real(column: Column | str) -> Column:
    return c(column).cast("double")


def big(column: Column | str) -> Column:
    return c(column).cast("bigint")


def text(column: Column | str) -> Column:
    return c(column).cast("string")


def day(column: Column | str) -> Column:
    """ISO date text."""
    return F.date_format(c(column), "yyyy-MM-dd")


def second(column: Column | str) -> Column:
    """ISO timestamp text, whole seconds."""
    return F.date_format(c(column), "yyyy-MM-dd HH:mm:ss")


def ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / den.cast("double")


def ntz(literal: str) -> Column:
    """Timestamp literal without time zone, the type of the stored timestamps."""
    return F.lit(literal).cast("timestamp_ntz")


def order_values(t: Tables) -> DataFrame:
    """orders with an exact amount column ``val`` and a date ``odate``."""
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.to_date("o_orderdate").alias("odate"),
        money("o_totalprice").alias("val"),
    )


def transactions(t: Tables) -> DataFrame:
    """events as account movements (actid, tranid, val)."""
    return t.events.select(
        F.col("user_id").alias("actid"),
        F.col("event_id").alias("tranid"),
        money("value").alias("val"),
    )


def supplier_months(t: Tables) -> DataFrame:
    """Quantity per supplier and month; at most one row per calendar month and key."""
    return t.lineitem.groupBy(
        F.col("l_suppkey").alias("empid"),
        F.to_date(F.date_trunc("month", "l_shipdate")).alias("ordmonth"),
    ).agg(F.sum(money("l_quantity")).alias("qty"))


SUPPLIER_MONTHS_SQL = """
SELECT l_suppkey AS empid, CAST(date_trunc('month', l_shipdate) AS DATE) AS ordmonth,
       SUM(CAST(l_quantity AS DECIMAL(18,2))) AS qty
FROM lineitem GROUP BY 1, 2
"""

TRANSACTIONS_SQL = """
SELECT user_id AS actid, event_id AS tranid, CAST(value AS DECIMAL(18,2)) AS val FROM events
"""

ORDER_VALUES_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       CAST(o_orderdate AS DATE) AS odate, CAST(o_totalprice AS DECIMAL(18,2)) AS val
FROM orders
"""

"""Documents (XML, JSON) made from relational rows, and read back to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_lines(lineitem: DataFrame) -> DataFrame:
    """All lines of every order, numbered from 1 within the order.

    Line numbers repeat in the table, so they only lead the order of the lines; lines
    alike in all columns are interchangeable. A document holds the lines of one order.
    """
    place = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag"
    number = F.expr(f"row_number() OVER (PARTITION BY l_orderkey ORDER BY {place})")
    return lineitem.select(
        F.col("l_orderkey").alias("orderid"),
        number.cast("bigint").alias("linenumber"),
        F.col("l_partkey").alias("productid"),
        F.col("l_returnflag").alias("mark"),
        F.col("l_quantity").cast("decimal(18,2)").alias("qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total"),
    )


def flag(condition: Column) -> Column:
    """-1 / 0, the way the change documents spell a boolean."""
    return F.when(condition, "-1").otherwise("0")


def order_xml(lines: DataFrame) -> DataFrame:
    """One document per order. Lines marked A are new, R deleted, N changed."""
    mark = F.col("mark")
    element = F.concat(
        F.lit('<OrderDetail LineNumber="'), F.col("linenumber").cast("string"),
        F.lit('" ProductID="'), F.col("productid").cast("string"),
        F.lit('" IsNew="'), flag(mark == "A"),
        F.lit('" IsDirty="'), flag(mark != "R"),
        F.lit('" IsDeleted="'), flag(mark == "R"),
        F.lit('"/>'),
    )
    body = F.array_join(F.array_sort(F.collect_list(element)), "")
    return lines.groupBy("orderid").agg(
        F.concat(F.lit("<OrderDetails>"), body, F.lit("</OrderDetails>")).alias("doc")
    )


XML_SCHEMA = (
    "OrderDetail array<struct<_LineNumber: bigint, _ProductID: bigint, "
    "_IsNew: string, _IsDirty: string, _IsDeleted: string>>"
)


def parse_order_xml(docs: DataFrame) -> DataFrame:
    """Documents back to one row per detail element."""
    details = docs.select(
        "orderid", F.explode(F.from_xml("doc", XML_SCHEMA)["OrderDetail"]).alias("d")
    )
    return details.select(
        "orderid",
        F.col("d._LineNumber").alias("linenumber"),
        F.col("d._ProductID").alias("productid"),
        F.col("d._IsNew").alias("is_new"),
        F.col("d._IsDirty").alias("is_dirty"),
        F.col("d._IsDeleted").alias("is_deleted"),
    )


def order_json(lines: DataFrame) -> DataFrame:
    """One JSON array of line objects per order, in line order."""
    item = F.struct(
        F.col("linenumber").alias("line"),
        F.struct(F.col("productid").alias("id"), F.col("qty").cast("bigint").alias("qty")).alias("item"),
    )
    return lines.groupBy("orderid").agg(F.to_json(F.array_sort(F.collect_list(item))).alias("items"))

"""Pivot and unpivot."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.aggregates import RAW, raw_data
from millrace.catalog.common import day, order_values, ratio, real, text
from millrace.operators import pivots as P
from millrace.registry import query

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
YEARS = list(range(1995, 2002))
#: Sales in which one cell of the table (region, category) has no known amount.
GAP = ("ASIA", "BUILDING")
GAPPED = f"SELECT region, category, CASE WHEN (region, category) <> {GAP} THEN amount END AS amount FROM ({RAW})"


def gapped_data(t):
    known = (F.col("region") != GAP[0]) | (F.col("category") != GAP[1])
    return raw_data(t).withColumn("amount", F.when(known, F.col("amount")))



def _sums(column: str, values, quote="'", cast="DOUBLE", prefix="", agg="SUM(CASE WHEN {c} = {v} THEN amount END)"):
    parts = []
    for v in values:
        expr = agg.format(c=column, v=f"{quote}{v}{quote}")
        parts.append(f"CAST({expr} AS {cast}) AS {prefix}{v}")
    return ", ".join(parts)


def _reals(df, columns):
    return df.withColumns({x: real(x) for x in columns})


@query(
    "crosstab_case",
    oracle=f"""
    SELECT region, {_sums('category', SEGMENTS)},
           {_sums('category', SEGMENTS, prefix='z_', agg='SUM(CASE WHEN {c} = {v} THEN amount ELSE 0 END)')}
    FROM ({GAPPED}) GROUP BY region
    """,
)
def crosstab_case(t):
    """Without ELSE an empty cell is NULL; with ELSE 0 it is zero."""
    rows = gapped_data(t)
    cell = lambda s: F.when(F.col("category") == s, F.col("amount"))
    return rows.groupBy("region").agg(
        *[real(F.sum(cell(s))).alias(s) for s in SEGMENTS],
        *[real(F.sum(cell(s).otherwise(F.lit(0)))).alias(f"z_{s}") for s in SEGMENTS],
    )


@query("pivot_sum", oracle=f"SELECT region, {_sums('category', SEGMENTS)} FROM ({RAW}) GROUP BY region")
def pivot_sum(t):
    return _reals(P.pivot(raw_data(t), ["region"], "category", SEGMENTS, F.sum("amount")), SEGMENTS)


@query(
    "pivot_implicit_group",
    oracle=f"""
    SELECT region, strftime(sales_date, '%Y-%m-%d') AS sales_date, {_sums('category', SEGMENTS)}
    FROM ({RAW}) GROUP BY region, sales_date
    """,
)
def pivot_implicit_group(t):
    wide = P.pivot_all_other_columns(raw_data(t), "category", "amount", SEGMENTS, F.sum("amount"))
    return _reals(wide, SEGMENTS).withColumn("sales_date", day("sales_date"))


@query(
    "pivot_with_total",
    oracle=f"""
    SELECT region, {_sums('category', SEGMENTS)},
           CAST({' + '.join(f"COALESCE(SUM(CASE WHEN category = '{s}' THEN amount END), 0)" for s in SEGMENTS)} AS DOUBLE) AS total
    FROM ({GAPPED}) GROUP BY region
    """,
)
def pivot_with_total(t):
    wide = P.pivot(gapped_data(t), ["region"], "category", SEGMENTS, F.sum("amount"))
    return _reals(P.with_row_total(wide, SEGMENTS, "total"), [*SEGMENTS, "total"])


def part_attributes(t):
    """part as attribute-value rows, all values text."""
    wide = t.part.select("p_partkey", text("p_size").alias("size"), F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    return P.unpivot(wide, ["p_partkey"], ["size", "brand", "type"], "attribute", "value")


@query(
    "pivot_attributes",
    oracle="SELECT p_partkey, CAST(p_size AS VARCHAR) AS size, p_brand AS brand, p_type AS type FROM part",
)
def pivot_attributes(t):
    return P.pivot(part_attributes(t), ["p_partkey"], "attribute", ["size", "brand", "type"], F.max("value"))


def yearly(t):
    return order_values(t).select("o_custkey", F.year("odate").alias("yr"), "val")


YEARLY = "SELECT o_custkey, year(o_orderdate) AS yr, CAST(o_totalprice AS DECIMAL(18,2)) AS val FROM orders"


@query(
    "pivot_matrix",
    oracle=f"""
    SELECT o_custkey, {', '.join(
        f"CAST(SUM(CASE WHEN yr = {y} THEN val END) AS DOUBLE) AS sum_{y}, "
        f"CAST(SUM(CASE WHEN yr = {y} THEN val END) AS DOUBLE) / COUNT(CASE WHEN yr = {y} THEN val END) AS avg_{y}, "
        f"COUNT(CASE WHEN yr = {y} THEN val END) AS n_{y}" for y in YEARS)}
    FROM ({YEARLY}) GROUP BY o_custkey
    """,
)
def pivot_matrix(t):
    """Sum, average and count per year, as the joined 0/1 matrix gives them."""
    cell = lambda y: F.when(F.col("yr") == y, F.col("val"))
    aggs = []
    for y in YEARS:
        known = F.count(cell(y))
        aggs += [
            real(F.sum(cell(y))).alias(f"sum_{y}"),
            F.when(known > 0, ratio(F.sum(cell(y)), known)).alias(f"avg_{y}"),
            known.alias(f"n_{y}"),
        ]
    return yearly(t).groupBy("o_custkey").agg(*aggs)


@query(
    "pivot_dynamic",
    oracle=f"SELECT o_custkey, {_sums('yr', range(1995, 2002), quote='', prefix='y', agg='SUM(CASE WHEN {c} = {v} THEN val END)')} FROM ({YEARLY}) GROUP BY o_custkey",
)
def pivot_dynamic(t):
    rows = yearly(t).withColumn("yr", F.concat(F.lit("y"), "yr"))
    wide = P.pivot_dynamic(rows, ["o_custkey"], "yr", "sum", "val")
    return _reals(wide, [x for x in wide.columns if x != "o_custkey"])


def wide_sales(t):
    """One row per customer with quantity and value columns for each year."""
    cell = lambda y, x: F.when(F.col("yr") == y, x)
    return yearly(t).groupBy("o_custkey").agg(
        *[F.nullif(F.count(cell(y, F.lit(1))), F.lit(0)).alias(f"qty{y}") for y in YEARS],
        *[F.sum(cell(y, F.col("val"))).alias(f"val{y}") for y in YEARS],
    )


LONG = f"""
SELECT o_custkey, CAST(yr AS BIGINT) AS yr, COUNT(*) AS qty, CAST(SUM(val) AS DOUBLE) AS val
FROM ({YEARLY}) GROUP BY o_custkey, yr
"""


@query("unpivot", oracle=f"SELECT o_custkey, 'val' || yr AS col, val FROM ({LONG})")
def unpivot(t):
    long = P.unpivot(wide_sales(t), ["o_custkey"], [f"val{y}" for y in YEARS], "col", "val")
    return long.withColumn("val", real("val"))


@query(
    "unpivot_cross_values",
    oracle=f"""
    SELECT c.o_custkey, 'val' || y.yr AS col, l.val FROM (SELECT DISTINCT o_custkey FROM orders) c
      CROSS JOIN (SELECT unnest(range(1995, 2002)) AS yr) AS y LEFT JOIN ({LONG}) l ON l.o_custkey = c.o_custkey AND l.yr = y.yr
    """,
)
def unpivot_cross_values(t):
    """Every row times every label, empty cells kept."""
    long = P.unpivot(wide_sales(t), ["o_custkey"], [f"val{y}" for y in YEARS], "col", "val", keep_nulls=True)
    return long.withColumn("val", real("val"))


@query("unpivot_multi_measure", oracle=LONG)
def unpivot_multi_measure(t):
    families = {"qty": [f"qty{y}" for y in YEARS], "val": [f"val{y}" for y in YEARS]}
    long = P.unpivot_families(wide_sales(t), ["o_custkey"], YEARS, families, "yr")
    return long.select("o_custkey", F.col("yr").cast("bigint").alias("yr"), "qty", real("val").alias("val"))

"""SQL functions, parameters, result contracts, views."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import routines as P
from millrace.registry import query


@query(
    "udf_scalar",
    oracle="SELECT o_orderkey, strftime(make_date(year(o_orderdate), 12, 31), '%Y-%m-%d') AS year_end FROM orders",
)
def udf_scalar(t):
    """A SQL function, inlined by the analyzer."""
    t.spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION end_of_year(d date) RETURNS date RETURN make_date(year(d), 12, 31)"
    )
    return t.sql("SELECT o_orderkey, cast(end_of_year(to_date(o_orderdate)) AS string) AS year_end FROM {orders}")


@query(
    "udf_inline_table",
    oracle="""
    SELECT c_custkey, o_orderkey, rn FROM customer JOIN
      (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
      ON o_custkey = c_custkey AND rn <= 2
    """,
)
def udf_inline_table(t):
    """A table function with a parameter, applied to every customer. It ranks
    before it filters, so Spark cuts each customer to n rows map-side."""
    t.orders.createOrReplaceTempView("fn_orders")
    t.spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION largest_orders(n int) RETURNS TABLE (custkey bigint, o_orderkey bigint, rn bigint)
        RETURN SELECT o_custkey, o_orderkey, rn FROM
          (SELECT o_custkey, o_orderkey, cast(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS bigint) AS rn FROM fn_orders)
        WHERE rn <= n
        """
    )
    return t.sql("SELECT c_custkey, o_orderkey, rn FROM {customer} JOIN largest_orders(2) AS f ON f.custkey = c_custkey")


@query(
    "udf_external",
    oracle="""
    SELECT c_custkey, c_name || c_mktsegment AS joined, c_name || '_NDT_' || c_mktsegment AS tagged, c_custkey + c_nationkey AS added FROM customer
    """,
)
def udf_external(t):
    P.register_external(t.spark)
    return t.sql(
        """
        SELECT c_custkey, join_text(c_name, c_mktsegment) AS joined, join_tagged(c_name, c_mktsegment) AS tagged,
               add_numbers(c_custkey, cast(c_nationkey AS bigint)) AS added FROM {customer}
        """
    )


@query(
    "parameterized_query",
    oracle="SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 350000 AND o_orderdate >= TIMESTAMP '1999-01-01'",
)
def parameterized_query(t):
    return t.sql(
        """
        SELECT o_orderkey, o_custkey FROM {orders}
        WHERE o_orderstatus = :status AND o_totalprice > :price AND o_orderdate >= cast(:since AS timestamp_ntz)
        """,
        args={"status": "O", "price": 350000.0, "since": "1999-01-01"},
    )


@query(
    "result_schema_contract",
    oracle="SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS supplier, CAST(CAST(s_nationkey AS BIGINT) AS DOUBLE) AS nation FROM supplier",
)
def result_schema_contract(t):
    rows = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return P.with_result_schema(rows, ("id", "string"), ("supplier", "string"), ("nation", "double"))


@query(
    "view",
    oracle="SELECT n_name, COUNT(*) AS n_customers FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 0 GROUP BY n_name",
)
def view(t):
    t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).createOrReplaceTempView("customer_nation")
    return t.spark.sql("SELECT n_name, count(*) AS n_customers FROM customer_nation WHERE c_acctbal > 0 GROUP BY n_name")

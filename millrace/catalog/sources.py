"""Scans, generated row sets, snapshots and partitioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import big, day, money, ntz, order_values, real
from millrace.operators import partitions as P
from millrace.registry import query
from millrace.sources.documents import order_lines, order_xml, parse_order_xml
from millrace.sources.tables import work_path

YEARS = ["1996-01-01", "1997-01-01", "1998-01-01", "1999-01-01", "2000-01-01", "2001-01-01"]
BUCKET_SQL = "(1" + "".join(
    f" + CASE WHEN o_orderdate >= TIMESTAMP '{y}' THEN 1 ELSE 0 END" for y in YEARS
) + ")"


def bounds():
    return [ntz(y) for y in YEARS]


@query("scan_table", oracle="SELECT c_custkey, c_name, c_mktsegment FROM customer")
def scan_table(t):
    return t.customer.select("c_custkey", "c_name", "c_mktsegment")


@query(
    "scan_range_pruned",
    oracle="""
    SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity
    FROM lineitem WHERE l_shipdate > TIMESTAMP '2000-06-30'
    """,
)
def scan_range_pruned(t):
    late = t.lineitem.where(F.col("l_shipdate") > ntz("2000-06-30"))
    return late.select("l_orderkey", "l_partkey", big("l_linenumber").alias("l_linenumber"), "l_quantity")


@query("scan_string_pushdown", oracle="SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#12'")
def scan_string_pushdown(t):
    return t.part.where(F.col("p_brand") == "Brand#12").select("p_partkey", "p_name")


@query(
    "values_rowset",
    oracle="""
    SELECT d.label, COUNT(*) AS n_orders
    FROM orders JOIN (VALUES ('F','finished'), ('O','open'), ('P','pending')) AS d(code, label)
      ON o_orderstatus = d.code
    GROUP BY d.label
    """,
)
def values_rowset(t):
    return t.sql(
        """
        SELECT d.label, count(*) AS n_orders
        FROM {orders} JOIN VALUES ('F','finished'), ('O','open'), ('P','pending') AS d(code, label)
          ON o_orderstatus = d.code
        GROUP BY d.label
        """
    )


@query(
    "number_series",
    oracle="SELECT n FROM (SELECT unnest(generate_series(MIN(o_orderkey), MAX(o_orderkey))) AS n FROM orders)",
)
def number_series(t):
    ends = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return t.spark.range(ends[0], ends[1] + 1).select(F.col("id").alias("n"))


@query(
    "synthetic_grid",
    oracle="""
    SELECT c_custkey AS actid, tranid, CAST((c_custkey * 7919 + tranid * 104729) % 2001 - 1000 AS BIGINT) AS val
    FROM customer CROSS JOIN generate_series(1, 20) AS s(tranid)
    """,
)
def synthetic_grid(t):
    grid = t.customer.select(
        F.col("c_custkey").alias("actid"), F.explode(F.sequence(big(F.lit(1)), big(F.lit(20)))).alias("tranid")
    )
    spread = F.pmod(F.col("actid") * 7919 + F.col("tranid") * 104729, F.lit(2001))
    return grid.withColumn("val", spread - 1000)


@query(
    "create_table_as",
    oracle="""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS odate, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS val
    FROM orders WHERE o_orderstatus = 'O'
    """,
)
def create_table_as(t):
    snapshot = work_path(t.spark, "create-table-as")
    source = order_values(t).where(F.col("o_orderstatus") == "O").select("o_orderkey", "odate", "val")
    source.where(F.lit(False)).write.parquet(snapshot)  # schema-only clone first
    source.write.mode("append").parquet(snapshot)
    return t.spark.read.parquet(snapshot).select("o_orderkey", day("odate").alias("odate"), real("val").alias("val"))


@query(
    "insert_select",
    oracle="""
    SELECT l_returnflag, COUNT(*) AS n_rows, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
    FROM lineitem GROUP BY l_returnflag
    """,
)
def insert_select(t):
    path = work_path(t.spark, "insert-select")
    lines = t.lineitem.select("l_orderkey", "l_returnflag", "l_quantity")
    lines.where(F.col("l_returnflag") == "R").write.parquet(path)
    for flag in ("A", "N"):
        lines.where(F.col("l_returnflag") == flag).write.mode("append").parquet(path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), real(F.sum(money("l_quantity"))).alias("qty")
    )


@query(
    "json_rowset_source",
    oracle="SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, c_acctbal AS balance FROM customer",
)
def json_rowset_source(t):
    path = work_path(t.spark, "json-source")
    exported = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("info"),
        F.col("c_nationkey").alias("nation"),
    )
    exported.write.json(path)
    read = t.spark.read.schema("id bigint, info struct<name: string, balance: double>, nation bigint").json(path)
    return read.select("id", "info.name", "nation", "info.balance")


@query(
    "json_export",
    oracle="""
    SELECT c_custkey, CAST(json_object('id', c_custkey, 'name', c_name, 'segment', c_mktsegment) AS VARCHAR) AS doc
    FROM customer
    """,
)
def json_export(t):
    doc = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return t.customer.select("c_custkey", F.to_json(doc).alias("doc"))


ORDER_LINES_SQL = """
SELECT l_orderkey AS orderid, l_partkey AS productid, l_returnflag AS mark,
       row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) AS linenumber,
       CAST(l_quantity AS DECIMAL(18,2)) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS total
FROM lineitem
"""


@query(
    "xml_rowset_source",
    oracle=f"""
    SELECT orderid, linenumber, productid FROM ({ORDER_LINES_SQL}) WHERE mark = 'A'
    """,
)
def xml_rowset_source(t):
    details = parse_order_xml(order_xml(order_lines(t.lineitem)))
    fresh = details.where((F.col("is_new") == "-1") & (F.col("is_dirty") == "-1"))
    return fresh.select("orderid", "linenumber", "productid")


@query(
    "partitioned_write",
    oracle=f"""
    SELECT CAST({BUCKET_SQL} AS BIGINT) AS bucket, COUNT(*) AS n_rows,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1
    """,
)
def partitioned_write(t):
    path = work_path(t.spark, "partitioned-write")
    P.write_partitioned(t.orders, path, F.col("o_orderdate"), bounds())
    return (
        t.spark.read.parquet(path)
        .groupBy(big("bucket").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n_rows"), real(F.sum(money("o_totalprice"))).alias("total"))
    )


@query("partition_number", oracle=f"SELECT o_orderkey, CAST({BUCKET_SQL} AS BIGINT) AS bucket FROM orders")
def partition_number(t):
    return t.orders.select("o_orderkey", big(P.partition_number(F.col("o_orderdate"), bounds())).alias("bucket"))


@query(
    "partition_stats",
    oracle=f"""
    SELECT CAST({BUCKET_SQL} AS BIGINT) AS bucket, COUNT(*) AS n_rows,
           strftime(MIN(o_orderdate), '%Y-%m-%d') AS low, strftime(MAX(o_orderdate), '%Y-%m-%d') AS high
    FROM orders GROUP BY 1
    """,
)
def partition_stats(t):
    routed = t.orders.withColumn(P.BUCKET, P.partition_number(F.col("o_orderdate"), bounds()))
    stats = P.partition_stats(routed, "o_orderdate")
    return stats.select(big("bucket").alias("bucket"), "n_rows", day("low").alias("low"), day("high").alias("high"))


COUNT_PER_BUCKET = """
SELECT CAST(bucket AS BIGINT) AS bucket, COUNT(*) AS n_rows FROM ({}) GROUP BY 1
"""


def _count_per_bucket(df):
    return df.groupBy(big("bucket").alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "partition_switch_in",
    oracle=COUNT_PER_BUCKET.format(f"SELECT {BUCKET_SQL} AS bucket FROM orders"),
)
def partition_switch_in(t):
    date = F.col("o_orderdate")
    table = P.PartitionedTable.create(t.orders.where(date < bounds()[-1]), work_path(t.spark, "switch-in"), "o_orderdate", bounds())
    staged = t.orders.where(date >= bounds()[-1])
    return _count_per_bucket(table.switch_in(staged, len(YEARS) + 1).read())


@query(
    "partition_switch_out",
    oracle=COUNT_PER_BUCKET.format(f"SELECT {BUCKET_SQL} AS bucket FROM orders")
    + " HAVING CAST(bucket AS BIGINT) <> 1 UNION ALL "
    + "SELECT CAST(-1 AS BIGINT), COUNT(*) FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'",
)
def partition_switch_out(t):
    """Remaining partitions, and the archived one as bucket -1."""
    table = P.PartitionedTable.create(t.orders, work_path(t.spark, "switch-out"), "o_orderdate", bounds())
    table = table.switch_out(1, "oldest")
    archived = table.switched_out("oldest").withColumn("bucket", F.lit(-1))
    return _count_per_bucket(table.read().unionByName(archived))


@query(
    "partition_split_merge",
    oracle=COUNT_PER_BUCKET.format(
        f"SELECT {BUCKET_SQL} + CASE WHEN o_orderdate >= TIMESTAMP '2000-07-01' THEN 1 ELSE 0 END"
        " - CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN 1 ELSE 0 END AS bucket"
        " FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'"
    ),
)
def partition_split_merge(t):
    """Year 2000 is split in halves; the emptied oldest partition is merged away."""
    table = P.PartitionedTable.create(t.orders, work_path(t.spark, "split-merge"), "o_orderdate", bounds())
    table = table.switch_out(1, "oldest").split(ntz("2000-07-01")).merge(1)
    return _count_per_bucket(table.read())

"""Dataset rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.changes import MOVES, movements
from millrace.catalog.common import big
from millrace.operators import quality as Q
from millrace.plans.ordered import heat_of, neighbours, running
from millrace.registry import query


@query(
    "check_rule",
    oracle="""
    WITH b AS (SELECT p_partkey, CAST(p_size AS BIGINT) AS a, CASE WHEN p_type <> 'PROMO' THEN 25 END AS b, 50 - CAST(p_size AS BIGINT) AS c FROM part)
    SELECT 'chain' AS rule, p_partkey FROM b WHERE NOT (a <= b AND b <= c)
    UNION ALL SELECT 'every_pair', p_partkey FROM b WHERE NOT (a <= b AND b <= c AND a <= c)
    UNION ALL SELECT 'strict', p_partkey FROM b WHERE NOT COALESCE(a <= b AND b <= c, FALSE)
    """,
)
def check_rule(t):
    """Box dimensions should ascend. With a NULL in the middle the chain of
    comparisons lets a wrong row pass; the two repairs catch it."""
    boxes = t.part.select(
        "p_partkey",
        big("p_size").alias("a"),
        F.when(F.col("p_type") != "PROMO", 25).alias("b"),
        (50 - big("p_size")).alias("c"),
    )
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    chain = (a <= b) & (b <= c)
    found = [
        ("chain", Q.check_violations(boxes, chain)),
        ("every_pair", Q.check_violations(boxes, chain & (a <= c))),
        ("strict", Q.check_violations(boxes, chain, strict=True)),
    ]
    x, y, z = [rows.select(F.lit(name).alias("rule"), "p_partkey") for name, rows in found]
    return x.unionByName(y).unionByName(z)


@query(
    "unique_rule",
    oracle="""
    WITH k AS (SELECT l_orderkey, CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS BIGINT) END AS line FROM lineitem)
    SELECT 'plain' AS rule, l_orderkey, line, COUNT(*) AS n_rows FROM k GROUP BY l_orderkey, line HAVING COUNT(*) > 1
    UNION ALL
    SELECT 'not_null_only', l_orderkey, line, COUNT(*) FROM k WHERE line IS NOT NULL GROUP BY l_orderkey, line HAVING COUNT(*) > 1
    """,
)
def unique_rule(t):
    keys = t.lineitem.select("l_orderkey", big(F.when(F.col("l_linenumber") < 7, F.col("l_linenumber"))).alias("line"))
    plain = Q.duplicate_keys(keys, ["l_orderkey", "line"]).withColumn("rule", F.lit("plain"))
    known = Q.duplicate_keys(keys, ["l_orderkey", "line"], skip_nulls=True).withColumn("rule", F.lit("not_null_only"))
    return plain.unionByName(known)


@query(
    "foreign_key_rule",
    oracle="""
    SELECT o_orderkey, o_custkey FROM (SELECT o_orderkey, nullif(o_custkey, 7) AS o_custkey FROM orders) o
    WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')
    """,
)
def foreign_key_rule(t):
    """Orders of customers missing from the parent table (which lacks one segment)."""
    child = t.orders.select("o_orderkey", F.nullif("o_custkey", F.lit(7)).alias("o_custkey"))
    parent = t.customer.where(F.col("c_mktsegment") != "BUILDING")
    return Q.orphans(child, parent, {"o_custkey": "c_custkey"})


@query(
    "balance_rule",
    oracle=f"""
    WITH l AS (SELECT item, moved, event_id, event_type, quantity, CAST(SUM(quantity) OVER (PARTITION BY item ORDER BY moved, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cur FROM ({MOVES})),
    p AS (SELECT *, lag(cur) OVER (PARTITION BY item ORDER BY moved, event_id) AS prev FROM l),
    s AS (SELECT *, CASE WHEN event_type = 'error' THEN cur + 1 ELSE cur END AS said FROM p)
    SELECT item, event_id, said AS current_quantity FROM
      (SELECT *, lag(said) OVER (PARTITION BY item ORDER BY moved, event_id) AS before FROM s)
    WHERE NOT (said = COALESCE(prev, 0) + quantity AND prev IS NOT DISTINCT FROM before)
    """,
)
def balance_rule(t):
    """Balances of error events are off by one: those rows and the ones that
    should continue them are reported."""
    order, moves = ["moved", "event_id"], movements(t)
    heat = heat_of(moves, ["item"])
    log = running(moves, ["item"], order, heat=heat, cur=("sum", F.col("quantity")))
    log = neighbours(log, ["item"], order, previous={"prev": "cur"}, heat=heat)
    said = F.col("cur") + F.when(F.col("event_type") == "error", 1).otherwise(0)
    log = log.withColumn("current_quantity", said)
    broken = Q.broken_chains(log, "item", order, "quantity", "current_quantity", "prev", heat)
    return broken.select("item", "event_id", "current_quantity")


@query(
    "cross_table_rule",
    oracle="""
    SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'O' AND NOT c_acctbal > 0
    """,
)
def cross_table_rule(t):
    """An open order needs a customer in good standing."""
    joined = t.orders.where(F.col("o_orderstatus") == "O").join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return Q.check_violations(joined, F.col("c_acctbal") > 0).select("o_orderkey")


@query(
    "duplicate_key_report",
    oracle="""
    SELECT DISTINCT p_brand, p_type, p_size_n FROM
      (SELECT p_brand, p_type, CAST(p_size AS BIGINT) AS p_size_n, COUNT(*) OVER (PARTITION BY p_brand, p_size) AS n FROM
        (SELECT DISTINCT p_brand, p_size, p_type FROM part)) WHERE n > 1
    """,
)
def duplicate_key_report(t):
    """Keys with the same leading part (brand, size) and a different rest (type)."""
    keys = t.part.select("p_brand", big("p_size").alias("p_size_n"), "p_type").distinct()
    repeated = Q.duplicate_keys(keys, ["p_brand", "p_size_n"])
    return keys.join(repeated, ["p_brand", "p_size_n"], "left_semi").select("p_brand", "p_type", "p_size_n")

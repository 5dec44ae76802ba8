"""Paths over node and edge tables, and a hierarchy.

Persons are customers, restaurants are parts, cities are nations. A person likes
the parts they ordered, lives in their nation and has one friend; a part is
located in the lowest nation of its suppliers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import big
from millrace.operators import graph as G
from millrace.registry import query


def likes(t):
    sold = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    return sold.select(F.col("o_custkey").alias("src"), F.col("l_partkey").alias("dst")).distinct()


def friend_of(t):
    people = t.customer.agg(F.count(F.lit(1))).scalar()
    return t.customer.select(
        F.col("c_custkey").alias("src"), F.pmod(F.col("c_custkey") * 7 + 1, people).alias("dst")
    )


def located_in(t):
    sold = t.lineitem.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    return sold.groupBy(F.col("l_partkey").alias("src")).agg(F.min("s_nationkey").alias("dst"))


LIKES = "SELECT DISTINCT o_custkey AS src, l_partkey AS dst FROM orders JOIN lineitem ON l_orderkey = o_orderkey"
FRIEND = "SELECT c_custkey AS src, (c_custkey * 7 + 1) % (SELECT COUNT(*) FROM customer) AS dst FROM customer"
LOCATED = "SELECT l_partkey AS src, MIN(s_nationkey) AS dst FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1"


@query(
    "match_one_hop",
    oracle=f"SELECT c_name, p_name, p_partkey FROM ({LIKES}) e JOIN customer ON c_custkey = e.src JOIN part ON p_partkey = e.dst",
)
def match_one_hop(t):
    hop = likes(t).join(t.customer, F.col("c_custkey") == F.col("src")).join(t.part, F.col("p_partkey") == F.col("dst"))
    return hop.select("c_name", "p_name", "p_partkey")


@query(
    "match_two_hop",
    oracle=f"""
    SELECT f.src AS person, COUNT(DISTINCT l.dst) AS n_liked FROM ({FRIEND}) f JOIN ({LIKES}) l ON l.src = f.dst GROUP BY f.src
    """,
)
def match_two_hop(t):
    """What friends like, counted per person."""
    paths = G.two_hops(friend_of(t), likes(t)).select("src", "dst").distinct()
    return paths.groupBy(F.col("src").alias("person")).agg(F.count(F.lit(1)).alias("n_liked"))


@query(
    "match_cycle",
    oracle=f"""
    SELECT c_custkey AS person, e.dst AS restaurant FROM ({LIKES}) e JOIN customer ON c_custkey = e.src
      JOIN ({LOCATED}) p ON p.src = e.dst AND p.dst = c_nationkey
    """,
)
def match_cycle(t):
    """Likes whose restaurant lies in the person's own city."""
    home = t.customer.select(F.col("c_custkey").alias("src"), F.col("c_nationkey").alias("city"))
    place = located_in(t).select(F.col("src").alias("dst"), F.col("dst").alias("city"))
    closed = likes(t).join(home, "src").join(place, ["dst", "city"])
    return closed.select(F.col("src").alias("person"), F.col("dst").alias("restaurant"))


@query(
    "friend_of_friend",
    oracle=f"SELECT a.src AS person, a.dst AS friend, b.dst AS friend_of_friend FROM ({FRIEND}) a JOIN ({FRIEND}) b ON b.src = a.dst",
)
def friend_of_friend(t):
    paths = G.two_hops(friend_of(t), friend_of(t))
    return paths.select(
        F.col("src").alias("person"), F.col("via").alias("friend"), F.col("dst").alias("friend_of_friend")
    )


@query(
    "common_neighbor",
    oracle=f"SELECT a.src AS person, b.src AS other, a.dst AS friend FROM ({FRIEND}) a JOIN ({FRIEND}) b ON a.dst = b.dst",
)
def common_neighbor(t):
    """In-degree is at most 7 here: 7*c+1 mod n repeats no value more often."""
    met = G.common_targets(friend_of(t))
    return met.select(F.col("src").alias("person"), "other", F.col("dst").alias("friend"))


@query(
    "edge_from_keys",
    oracle="""
    SELECT c_custkey AS src, CAST(n_nationkey AS BIGINT) AS dst FROM customer JOIN nation ON n_nationkey = c_nationkey
    """,
)
def edge_from_keys(t):
    """Pairs given by names are turned into pairs of node ids."""
    pairs = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select("c_name", "n_name")
    people = t.customer.select(F.col("c_custkey").alias("node_id"), "c_name")
    cities = t.nation.select(big("n_nationkey").alias("node_id"), "n_name")
    return G.edges_from_keys(pairs, people, cities, "c_name", "n_name")


def employees(t):
    """Suppliers as a tree: the manager of key k is (k - 1) div 4."""
    key = F.col("s_suppkey")
    return t.supplier.select(
        key.alias("empid"), F.when(key > 0, F.floor((key - 1) / 4)).cast("bigint").alias("mgrid"), F.col("s_name").alias("empname")
    )


TREE = """
WITH RECURSIVE e AS (SELECT s_suppkey AS empid, CASE WHEN s_suppkey > 0 THEN (s_suppkey - 1) // 4 END AS mgrid,
                            s_name AS empname FROM supplier),
t AS (SELECT empid, mgrid, empname, CAST(0 AS BIGINT) AS lvl FROM e WHERE empid = {root}
      UNION ALL SELECT e.empid, e.mgrid, e.empname, t.lvl + 1 FROM e JOIN t ON e.mgrid = t.empid WHERE t.lvl < {depth})
"""


@query("subtree", oracle=TREE.format(root=1, depth=1000) + "SELECT empid, mgrid, empname FROM t")
def subtree(t):
    return G.subtree(employees(t), "empid", "mgrid", 1).drop("lvl")


@query("subtree_levels", oracle=TREE.format(root=0, depth=2) + "SELECT empid, mgrid, empname, lvl FROM t")
def subtree_levels(t):
    return G.subtree(employees(t), "empid", "mgrid", 0, max_levels=2)

"""Path patterns over edge tables and walks down a hierarchy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import discard, materialise


def edges_from_keys(
    pairs: DataFrame, sources: DataFrame, targets: DataFrame, source_key: str, target_key: str,
    attributes: Sequence[str] = (),
) -> DataFrame:
    """Edges (src, dst) for pairs of business keys, with attributes of the pairs such as a
    rating; node tables have ``node_id``."""
    a = sources.select(F.col("node_id").alias("src"), source_key)
    b = targets.select(F.col("node_id").alias("dst"), target_key)
    return pairs.join(a, source_key).join(b, target_key).select("src", "dst", *attributes)


def two_hops(first: DataFrame, second: DataFrame) -> DataFrame:
    """Paths a -> b -> c as (src, via, dst)."""
    second = second.select(F.col("src").alias("via"), F.col("dst").alias("_end"))
    return (
        first.select("src", F.col("dst").alias("via")).join(second, "via").select("src", "via", F.col("_end").alias("dst"))
    )


def common_targets(edges: DataFrame) -> DataFrame:
    """Pairs of nodes with an edge to the same node, each node paired with itself.

    The pairs are the result asked for; use on edges of bounded in-degree.
    """
    other = edges.select(F.col("src").alias("other"), "dst")
    return edges.join(other, "dst").select("src", "other", "dst")


#: Pointers are composed this often before they are stored; each time doubles their reach.
DOUBLINGS = 2


def subtree(
    nodes: DataFrame,
    node: str,
    parent: str,
    root: object,
    max_levels: int | None = None,
    refuse_cycles: bool = False,
) -> DataFrame:
    """A node and its descendants with level numbers; node ids are unique.

    Every node holds a pointer to an ancestor and its distance, at first to its parent. A
    step replaces the pointer by that of the ancestor, which doubles its reach, until it
    points at the root or there is nothing further up; so a tree of depth d takes about
    log4(d) stored tables, not one for each level. Only ids are joined; the other columns
    are joined once to the nodes that were found. With ``max_levels`` pointers that reach
    further are dropped. The edge above the root is ignored. Nodes in or below a cycle never
    reach the root: they are left out, or refused on request.
    """
    level_of = lambda n: F.lit(n).cast("bigint").alias("_hops")
    above = nodes.where((F.col(node) != root) & F.col(parent).isNotNull())
    walk = above.select(F.col(node).alias("_node"), F.col(parent).alias("_up"), level_of(1))

    def near(df: DataFrame) -> DataFrame:
        return df if max_levels is None else df.where(F.col("_hops") <= max_levels)

    walk = materialise(near(walk), "pointers")
    arrived = F.col("_up") == root
    reach, most = 1, None
    while not walk.where(~arrived).isEmpty():
        most = walk.count() if most is None else most
        if reach > most:  # longer than any path without a cycle
            if refuse_cycles:
                raise ValueError(f"the nodes hold a cycle of {parent}")
            break
        before = walk
        for _ in range(DOUBLINGS):
            hop = walk.select(F.col("_node").alias("_mid"), F.col("_up").alias("_next"), F.col("_hops").alias("_more"))
            jumped = walk.where(~arrived).join(hop, F.col("_up") == F.col("_mid"))
            jumped = jumped.select("_node", F.col("_next").alias("_up"), (F.col("_hops") + F.col("_more")).alias("_hops"))
            walk = near(walk.where(arrived).unionByName(jumped))
            reach *= 2
        walk = materialise(walk, "pointers")
        discard(before)
    start = nodes.where(F.col(node) == root).select(F.col(node).alias("_node"), level_of(0))
    below = walk.where(arrived).select("_node", "_hops")
    if start.isEmpty():
        below = below.where(F.lit(False))
    ids = start.unionByName(below).withColumnRenamed("_hops", "lvl")
    return nodes.join(ids, F.col(node) == F.col("_node")).select(*nodes.columns, "lvl")

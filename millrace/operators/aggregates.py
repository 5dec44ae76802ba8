"""Grouping patterns beyond groupBy().agg()."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def group_by_all(df: DataFrame, keys: Sequence[str], condition: Column, **aggs: tuple[str, Column]) -> DataFrame:
    """Aggregates over the rows that meet a condition, keeping the groups that
    have none (count 0, other aggregates NULL)."""
    fold = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}
    return df.groupBy(*keys).agg(*[fold[f](F.when(condition, x)).alias(n) for n, (f, x) in aggs.items()])


def arg_max(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Rows holding the largest measure of their group, ties kept. The rank filter
    is applied on the map side first, so a group is cut down before the shuffle."""
    w = W.partitionBy(*keys).orderBy(F.desc(measure))
    return df.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") == 1).drop("_rank")


def ordered_list(value: Column, sep: str = ",") -> Column:
    """Distinct values of a group as sorted delimited text. Meant for values of a
    small domain: the set, not the group, is what has to fit."""
    return F.array_join(F.array_sort(F.collect_set(value)), sep)

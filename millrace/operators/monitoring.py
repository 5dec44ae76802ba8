"""Reports over event and counter tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def counter_deltas(snapshots: DataFrame, key: str, at: str, counters: Sequence[str]) -> DataFrame:
    """Growth of running counters between consecutive snapshots of a key. The
    snapshots are on a fixed grid (hours), which bounds the rows of a key."""
    w = W.partitionBy(key).orderBy(at)
    rows = snapshots.withColumns(
        {"started": F.lag(at).over(w), **{f"d_{x}": F.col(x) - F.lag(x).over(w) for x in counters}}
    )
    seconds = F.unix_timestamp(F.col(at).cast("timestamp")) - F.unix_timestamp(F.col("started").cast("timestamp"))
    return rows.where(F.col("started").isNotNull()).withColumn("seconds", seconds)


def best_row(df: DataFrame, key: str, allowed: dict[str, str], metric: str, tiebreak: str) -> DataFrame:
    """The row of each key with the highest metric; the metric is an argument
    looked up in a list of allowed columns."""
    if metric not in allowed:
        raise ValueError(f"cannot rank by {metric!r}")
    rest = [x for x in df.columns if x != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(allowed[metric]), F.col(tiebreak))).alias("_b"))
    return best.select(key, "_b.*")


def findings(rules: Sequence[tuple[int, str, DataFrame, Column]]) -> DataFrame:
    """Outputs of several rules in one table (priority, finding, detail)."""
    parts = [
        rows.select(F.lit(priority).cast("bigint").alias("priority"), F.lit(name).alias("finding"), detail.alias("detail"))
        for priority, name, rows, detail in rules
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("priority", "finding", "detail")
